"""The end-to-end batch job writes every result, and its rating equals the direct one."""

import tempfile

import pytest
from micro import micro_df

from txrisk.plans.report import run_report
from txrisk.plans.riskrun import RiskRun


def test_report_writes_every_result(spark):
    tx = micro_df(spark)
    out = tempfile.mkdtemp(prefix="txrisk-report-") + "/month"
    paths = run_report(spark, tx, out)
    assert {"import_completeness", "frequency_histogram", "risk_rating", "outlier_transactions",
            "top_outlier_transactions", "segment_thresholds", "romania_rule_hits"} <= set(paths)
    written = sorted((tuple(r) for r in spark.read.parquet(paths["risk_rating"]).collect()), key=repr)
    direct = sorted((tuple(r) for r in RiskRun(tx).rating.collect()), key=repr)
    assert written == direct
    assert spark.read.parquet(paths["outlier_transactions"]).count() == RiskRun(tx).outliers().count()


@pytest.mark.parametrize("seed", [5, 6])
def test_roll_ups_of_the_cube_equal_the_standalone_results(spark, seed):
    from test_random_oracle import random_rows

    from txrisk.operators import cube as cb
    from txrisk.operators import explore, quality
    from txrisk.operators import features as feat
    from txrisk.sources.ingest import clean
    from txrisk.sources.schema import TRANSACTION_SCHEMA

    tx = spark.createDataFrame(random_rows(seed), TRANSACTION_SCHEMA).cache()
    thirds = [cb.transaction_cube(tx.where(c)) for c in ("TransactionAmount % 3 = 0", "not TransactionAmount % 3 = 0", "TransactionAmount is null")]
    cube = cb.merge_cubes(*thirds).cache()
    direct = {**quality.check_all(tx, clean(tx)), **explore.explore_all(tx)}
    results = cb.cube_results(cube)
    assert len(results) == 15
    shape = lambda df: [(f.name, f.dataType) for f in df.schema.fields]
    for name, got in results.items():
        want = direct[name]
        assert shape(got) == shape(want), name
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())), name
    got, want = cb.profile_of(cube), feat.customer_profile(tx)
    assert shape(got) == shape(want)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert cb.import_completeness(cube.limit(0)).collect() == quality.import_completeness(tx.limit(0)).collect()


def test_cli_ingests_once_and_writes_every_result(spark, capsys):
    from pathlib import Path

    from micro import MICRO_ROWS

    from txrisk.plans.report import main

    d = Path(tempfile.mkdtemp(prefix="txrisk-cli-"))
    lines = [";".join("" if v is None else str(v) for v in r) for r in MICRO_ROWS] + ["99;Debit;9.5;SE"]
    (d / "tx.txt").write_text("\n".join(lines) + "\n")
    main([str(d / "tx.txt"), str(d / "out"), "--shuffle-partitions", "8"])
    printed = dict(line.split("\t") for line in capsys.readouterr().out.strip().splitlines())
    assert {"loaded", "import_completeness", "risk_rating", "romania_rule_hits"} <= set(printed)
    loaded = spark.read.parquet(printed["loaded"])
    assert loaded.where("load_status = 'unparsable'").count() == 1
    assert spark.read.parquet(printed["import_completeness"]).first()["total_records"] == len(MICRO_ROWS)
    assert spark.read.parquet(printed["risk_rating"]).count() == RiskRun(micro_df(spark)).rating.count()
