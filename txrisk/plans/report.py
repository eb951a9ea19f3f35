"""The whole monthly run as one batch job: checks, exploration, rating, outliers, rule.

Every result is written by the cluster under ``out/<name>``; nothing is collected.
The facts are summed up once, by customer, sign and country (``transaction_cube``); 15 checks
and exploration results, the customer profile with all features, and the high-risk country's
incoming amounts are roll-ups of that kept table. The facts are read again only where rows
are returned or met: the alert pass, row listings, and the two checks by amount.

    python -m txrisk.plans.report /data/transactions.txt /data/out

The text file is parsed once into ``out/loaded`` (parquet split by load status, the
quarantined lines included); every result then reads that table.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from txrisk.config import DEFAULT, RiskConfig
from txrisk.operators import explore, quality, rules
from txrisk.operators import rating as rat
from txrisk.operators.cube import cube_results, profile_of, transaction_cube
from txrisk.plans.riskrun import RiskRun
from txrisk.session import Workspace
from txrisk.sources.ingest import clean, ingest_transactions, read_ingested
from txrisk.sources.sinks import write_result


def run_report(spark: SparkSession, tx: DataFrame, out: str, cfg: RiskConfig = DEFAULT, fmt: str = "parquet") -> dict[str, str]:
    """Write every result for the transactions ``tx``; returns name -> path."""
    paths: dict[str, str] = {}

    def save(name: str, df: DataFrame) -> None:
        path = f"{out.rstrip('/')}/{name}"
        write_result(df, path, fmt)
        paths[name] = path

    def keep(name: str, df: DataFrame) -> DataFrame:
        """Save a result that others are built on. They read it back from parquet: the saved
        result itself, or a kept copy where results are written as text."""
        if fmt != "parquet":
            df = folder.keep(df)
        save(name, df)
        return spark.read.schema(df.schema).parquet(paths[name]) if fmt == "parquet" else df

    folder = Workspace(spark, "report")
    cleaned = clean(tx)
    cube = keep("transaction_cube", transaction_cube(tx, cfg))
    shared = cube_results(cube, cfg)
    for name, df in {**quality.check_all(tx, cleaned, cfg), **explore.explore_all(tx, cfg, cube)}.items():
        save(name, shared.get(name, df))

    with RiskRun(tx, cfg, profile=folder.keep(profile_of(cube, cfg))) as run:
        save("sign_thresholds", run.thresholds)
        alerts = run.alert_rows  # kept: read for the counts, the outliers and the top list
        save("unusual_alerts", run.alerts)
        wide = keep("risk_features_wide", run.wide)
        rating = keep("risk_rating", rat.risk_rating(rat.risk_points(wide, cfg), cfg))
        save("segment_summary", rat.segment_summary(rating))
        save("outlier_transactions", rules.outlier_transactions(alerts, rating))
        save("top_outlier_transactions", run.top_outliers())
        save("segment_outliers", rules.segment_outliers(run.raw, run.profile, rating, cfg, run.hot))
        incoming = keep("romania_incoming", rules.country_incoming(run.profile, rating, cfg))
        save("segment_thresholds", rules.segment_thresholds(incoming, cfg))
        save("segment_limits", rules.segment_limits(incoming, cfg))
        save("romania_rule_hits", rules.rule_hits(incoming, cfg))
    folder.drop()
    return paths


def main(argv: list[str] | None = None) -> None:
    from txrisk.session import build_session, ensure_checkpoint_dir

    ap = argparse.ArgumentParser(description="Run every check, the risk rating and the rules on a transaction file.")
    ap.add_argument("input", help="';'-delimited transaction file(s), no header")
    ap.add_argument("out", help="output folder (one sub-folder per result)")
    ap.add_argument("--sep", default=";", help="field separator of the input (default ';')")
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv"], help="format of the results")
    ap.add_argument(
        "--shuffle-partitions", type=int, default=200, help="about input bytes / 256 MB; AQE coalesces small ones"
    )
    args = ap.parse_args(argv)
    spark = build_session(master=None, shuffle_partitions=args.shuffle_partitions)
    ensure_checkpoint_dir(spark)
    # Parse the text once: good and quarantined lines land in one parquet folder split
    # by load status, and every result then reads pruned columns from parquet.
    loaded = f"{args.out.rstrip('/')}/loaded"
    ingest_transactions(spark, args.input, loaded, args.sep)
    print(f"loaded\t{loaded}")
    for name, path in run_report(spark, read_ingested(spark, loaded), args.out, fmt=args.format).items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
