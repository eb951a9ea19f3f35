"""Scale-and-skew probe (a developer tool, not a registered query).

Grows the ``tx_lines`` fixture N times (customer ids shifted per copy) and sends a
third of all rows to one customer, writes it once as parquet in a fresh temporary
folder, then runs the full rating with default AQE settings. Prints timings and
whether AQE split skewed join partitions.

    python tools/skew_probe.py /root/testdata/sf0.1 40 [existing_parquet_dir] [skew_threshold]

``skew_threshold`` (e.g. 32m) lowers AQE's skewed-partition size so the split shows at
this data size; at production sizes the default (256 MB) is far below a hot customer.
Results are written to the ``noop`` sink with every column, so no join is pruned away.
"""

from __future__ import annotations

import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from txrisk.plans.riskrun import RiskRun  # noqa: E402
from txrisk.session import build_session, ensure_checkpoint_dir  # noqa: E402
from txrisk.sources.fixtures import tx_lines  # noqa: E402
from txrisk.sources.schema import ID  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 40
    existing = sys.argv[3] if len(sys.argv) > 3 else ""
    extra = {"spark.driver.memory": "12g"}
    if len(sys.argv) > 4:
        extra["spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"] = sys.argv[4]
        extra["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = sys.argv[4]
    spark = build_session("local[8]", 64, app="txrisk-skew-probe", **extra)
    ensure_checkpoint_dir(spark)
    if existing:
        probe(spark, spark.read.parquet(existing))
        return
    base = tx_lines(spark, sf_dir)
    grown = base.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    hot = (F.xxhash64(F.col("_copy"), F.monotonically_increasing_id()) % 3) == 0
    grown = grown.withColumn(ID, F.when(hot, F.lit(424242)).otherwise(F.col(ID) + F.col("_copy") * 1_000_000)).drop("_copy")
    path = tempfile.mkdtemp(prefix="txrisk-probe-") + "/tx"
    t0 = time.perf_counter()
    grown.repartition(64).write.parquet(path)
    tx = spark.read.parquet(path)
    print(f"rows={tx.count()} written to {path} in {time.perf_counter() - t0:.1f}s", flush=True)
    probe(spark, tx)


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def probe(spark, tx) -> None:
    t0 = time.perf_counter()
    run = RiskRun(tx)
    t1 = time.perf_counter()
    rating = run.rating
    _noop(rating)
    t2 = time.perf_counter()
    print(f"profile {t1 - t0:.1f}s (rows={run.profile_rows}), "
          f"rating {t2 - t1:.1f}s", flush=True)
    # the write ran its own plan; inspect the same plan as a collected query
    hot = run.alerts.where(F.col(ID) == 424242)
    rows = run.alerts.collect()
    plan = run.alerts._jdf.queryExecution().executedPlan().toString()
    print(f"alerts: {len(rows)} customers; skewed partition split by AQE: {'skew=true' in plan}")
    print("hot customer alerts:", [r.asDict() for r in hot.collect()])


if __name__ == "__main__":
    main()
