"""A customer holding a third of all rows (half of them exact copies), and hot keys that can
never alert: no task may meet a third of the rows by their key, whatever AQE does."""

import random

import pytest
from pyspark.sql import functions as F

from txrisk.operators import features as feat
from txrisk.plans.riskrun import RiskRun
from txrisk.sources.schema import TRANSACTION_SCHEMA

#: Neither AQE's skew handling nor a broadcast may help.
PLAIN_CONF = {
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
}


def _rows(hot, n=30000, seed=3):
    """A third of the rows from ``hot(i, rng)``, the others of about 2000 customers."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            rows.append(hot(i, rng))
        else:
            rows.append((rng.randint(2, 2000), rng.choice(["Credit", "Debit"]), rng.randint(-5, 20000),
                         rng.choice(["FI", "DK", "SE", "RO", None])))
    return rows


HOT = {
    "half copies": lambda i, rng: (1, "Credit", 500 if i % 2 else rng.randint(1, 100000), "FI"),
    "all copies": lambda i, rng: (1, "Credit", 500, "FI"),
    "null customer": lambda i, rng: (None, "Credit", rng.randint(1, 100000), "FI"),
    "null sign": lambda i, rng: (1, None, rng.randint(1, 100000), "FI"),
    "never positive": lambda i, rng: (1, "Credit", -rng.randint(0, 100000), "FI"),
}


@pytest.fixture
def plain_joins(spark):
    old = {k: spark.conf.get(k) for k in PLAIN_CONF}
    for k, v in PLAIN_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _expected_alerts(rows):
    """Brute force of the alert counts, in whole numbers."""
    groups = {}
    for cid, sign, amt, _ in rows:
        if cid is not None and sign is not None and amt > 0:
            groups.setdefault((cid, sign), []).append(amt)
    out = {}
    for cid, *_ in rows:
        seen, hits = out.get(cid, (0, 0))
        out[cid] = (seen + (cid is not None), hits)
    for (cid, _), xs in groups.items():
        n, s, q = len(xs), sum(xs), sum(x * x for x in xs)
        hits = sum(n * x >= s and (n * x - s) ** 2 >= 4 * (n * q - s * s) for x in xs)
        out[cid] = (out[cid][0], out[cid][1] + hits)
    return out


@pytest.mark.parametrize("kind", HOT)
def test_hot_keys_give_right_alerts_and_even_tasks(spark, plain_joins, kind, tmp_path):
    rows = _rows(HOT[kind])
    spark.createDataFrame(rows, TRANSACTION_SCHEMA).repartition(8).write.parquet(str(tmp_path / "tx"))
    tx = spark.read.parquet(str(tmp_path / "tx"))
    run = RiskRun(tx)
    assert {r[0]: (r[1], r[2]) for r in run.alerts.collect()} == _expected_alerts(rows)
    # every fact row that could alert, as the join meets it: before the bound is applied
    everything = feat.sign_bounds(run.profile).withColumn("alert_from", F.lit(0).cast("long"))
    met = feat.alert_rows(tx, everything, run.hot).select("CustomerID", F.spark_partition_id().alias("task"))
    cold = met.where("CustomerID <> 1").groupBy("task").count().collect()
    assert max(r[1] for r in cold) < 2200  # 20000 other rows over 16 tasks
    hot = met.where("CustomerID = 1").groupBy("task").count().collect()
    if kind in ("half copies", "all copies"):  # met where they are scanned: no task has more than a file's
        assert sum(r[1] for r in hot) == 10000 and max(r[1] for r in hot) <= 10000 / tx.rdd.getNumPartitions() + 200
    else:
        assert run.hot is None or not hot


def test_one_exchange_of_facts_on_customer_and_sign(spark, plain_joins, tmp_path):
    spark.createDataFrame(_rows(HOT["half copies"], 3000), TRANSACTION_SCHEMA).write.parquet(str(tmp_path / "tx"))
    tx = spark.read.parquet(str(tmp_path / "tx"))
    run = RiskRun(tx)
    plan = feat.alert_rows(tx, feat.reached_bounds(run.profile))._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    facts = [line for line in scans if "GreaterThan(TransactionAmount,0)" in line]
    assert len(scans) == 2 and len(facts) == 1  # the facts and the kept profile
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2  # facts and bounds by key
    # rows of a hot group meet their bounds without any exchange
    assert run.hot.count() == 1
    plan = feat.alert_rows(tx, feat.reached_bounds(run.profile), run.hot)._jdf.queryExecution().executedPlan().toString()
    branch = plan[plan.index("Union") : plan.index("SortMergeJoin")]
    assert "BroadcastHashJoin" in branch and plan.count("Exchange hashpartitioning") == 2


def test_only_groups_that_can_alert_meet_the_facts(spark):
    rows = [(1, "Credit", 10, "FI")] * 4 + [(1, "Credit", 60, "FI")] + [(2, "Debit", x, "FI") for x in (10, 11, 12)] + [(3, "Credit", -5, "FI")]
    run = RiskRun(spark.createDataFrame(rows, TRANSACTION_SCHEMA))
    assert [tuple(r) for r in feat.reached_bounds(run.profile).select("CustomerID", "alert_from").collect()] == [(1, 60)]
    assert feat.sign_bounds(run.profile).count() == 2


def test_copies_are_written_in_order(spark, monkeypatch):
    from txrisk.functions import ordering

    monkeypatch.setattr(ordering, "COPY_BLOCK", 3)
    rows = [(1, "Credit", 1, "FI")] * 100 + [(1, "Credit", 90, "FI")] * 4 + [(1, "Credit", 80, "FI")]
    out = RiskRun(spark.createDataFrame(rows, TRANSACTION_SCHEMA)).outliers().collect()
    assert [r["TransactionAmount"] for r in out] == [90] * 4 + [80]


@pytest.mark.parametrize("hot", ["half copies", "all copies"])
def test_rows_of_listed_customers_stay_where_they_are_scanned(spark, plain_joins, hot, tmp_path, monkeypatch):
    from txrisk.operators import explore

    rows = _rows(HOT[hot], 6000) + [(1, "Debit", 5, "RO"), (-70, "Debit", 5, "RO"), (0, "Debit", 5, "RO"), (None, "Debit", 5, "RO")]
    spark.createDataFrame(rows, TRANSACTION_SCHEMA).repartition(8).write.parquet(str(tmp_path / "tx"))
    tx = spark.read.parquet(str(tmp_path / "tx"))
    ids = {r[0] for r in rows if r[3] == "RO" and r[0] is not None}
    want = sorted((r for r in rows if r[0] in ids), key=repr)
    found = explore.customers_with_country(tx, ["RO"], order=False)
    assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, found.collect()), key=repr) == want
    ordered = [tuple(r) for r in explore.customers_with_country(tx, ["RO"]).collect()]
    assert sorted(ordered, key=repr) == want and [r[0] for r in ordered] == sorted(r[0] for r in ordered)
    monkeypatch.setattr(explore, "MAX_WORDS", 0)  # too many ids for a broadcast
    joined = explore.customers_with_country(tx, ["RO"], order=False)
    assert "LeftSemi" in joined._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, joined.collect()), key=repr) == want


def test_top_outliers_of_none(spark):
    rows = [(1, "Credit", 1, "FI")] * 100 + [(1, "Credit", 90, "FI")]
    assert RiskRun(spark.createDataFrame(rows, TRANSACTION_SCHEMA)).top_outliers(0).count() == 0
