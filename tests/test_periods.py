"""Months stored as cubes, the high-risk list as a table, and the checked hand-off."""

import pytest
from micro import micro_df
from pyspark.sql import functions as F

from txrisk.operators import features as feat
from txrisk.operators import rules
from txrisk.operators.cube import profile_of, transaction_cube
from txrisk.plans.periods import PeriodStore
from txrisk.plans.riskrun import RiskRun
from txrisk.sources import sinks
from txrisk.sources.schema import COLUMNS, TRANSACTION_SCHEMA

MONTHS = ("2024-06", "2024-07")


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def months(spark, tmp_path_factory):
    """Two months of transactions, each in a file of its own."""
    tx = micro_df(spark)
    own = {m: tx.where(F.coalesce(F.pmod(F.col("TransactionAmount"), F.lit(2)) == k, F.lit(k == 0))) for k, m in enumerate(MONTHS)}
    out = {}
    for m, df in own.items():
        path = str(tmp_path_factory.mktemp("tx") / m)
        df.write.parquet(path)
        out[m] = spark.read.parquet(path)
    return out


@pytest.mark.parametrize("steps", [MONTHS, MONTHS[::-1], (*MONTHS, MONTHS[0]), (*MONTHS[::-1], "wrong")])
def test_any_order_of_loads_gives_the_joint_run(spark, months, tmp_path, steps):
    store = PeriodStore(spark, str(tmp_path / "store"))
    if "wrong" in steps:  # a faulty delivery, replaced by the right one
        store.load(months[MONTHS[0]].limit(3), MONTHS[1])
    for m in steps:
        if m != "wrong":
            store.load(months[m], m)
    joint = months[MONTHS[0]].unionByName(months[MONTHS[1]])
    assert rows(store.profile(MONTHS)) == rows(feat.customer_profile(joint))
    assert rows(store.features(MONTHS)) == rows(RiskRun(joint).features)
    assert rows(store.thresholds(MONTHS)) == rows(RiskRun(joint).thresholds)
    assert rows(store.run(joint, MONTHS).rating) == rows(RiskRun(joint).rating)
    assert rows(store.features(MONTHS[:1])) == rows(RiskRun(months[MONTHS[0]]).features)


def test_one_delivery_of_several_months(spark, months, tmp_path):
    both = months[MONTHS[0]].withColumn("period", F.lit(MONTHS[0])).unionByName(months[MONTHS[1]].withColumn("period", F.lit(MONTHS[1])))
    store, single = PeriodStore(spark, str(tmp_path / "a")), PeriodStore(spark, str(tmp_path / "b"))
    store.load(both)
    for m in MONTHS:
        single.load(months[m], m)
    assert rows(store.cubes()) == rows(single.cubes())
    wide = {r["period"] for r in store.rolling_thresholds(2).collect()}
    assert wide == set(MONTHS)
    last = store.rolling_thresholds(2).where(F.col("period") == MONTHS[1]).drop("period")
    assert rows(last) == rows(store.thresholds(MONTHS).select(*last.columns))
    assert {r["period"] for r in store.monthly_incoming().collect()} <= wide


def test_old_facts_are_not_read_again(spark, months, tmp_path):
    store = PeriodStore(spark, str(tmp_path / "store"))
    for m in MONTHS:
        store.load(months[m], m)
    old = set(months[MONTHS[0]].inputFiles())
    for df in (store.features(MONTHS), store.thresholds(MONTHS), store.judge(months[MONTHS[1]], MONTHS), store.rolling_thresholds(2), store.monthly_incoming()):
        assert df.inputFiles() and not old & set(df.inputFiles())
    # a new month's rows judged by the window
    limits = {(r[0], r[1]): r["threshold_single_transaction"] for r in store.thresholds(MONTHS).collect()}
    want = [r for r in months[MONTHS[1]].select(*COLUMNS).collect() if r[2] and r[2] > 0 and r[2] >= limits.get((r[0], r[1]), 1e18)]
    assert store.judge(months[MONTHS[1]], MONTHS).count() == len(want) > 0


def test_a_listed_country_rates_and_hits(spark):
    tx = spark.createDataFrame(
        [(1, "Credit", 50_000, "NO"), (1, "Credit", 10, "FI"), (2, "Credit", 7, "PL"), (2, "Credit", 8, "RO"), (3, "Credit", 9, "SE"), (None, "Credit", 4, "NO")], TRANSACTION_SCHEMA
    )
    listed = spark.createDataFrame([("NO",), ("RO",), ("NO",), (None,)], "CountryName string")
    run = RiskRun(tx, profile=profile_of(transaction_cube(tx), high_risk=listed))
    points = {r["CustomerID"]: r["HRCFlag"] for r in run.points.collect()}
    assert points == {1: 3, 2: 3, 3: 0, None: 0}
    assert {(r[0], r[1]) for r in run.incoming.collect()} == {(1, 50_000), (2, 8), (None, 4)}
    assert {r[0] for r in run.rule_hits.collect()} >= {1}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_what_is_handed_off_reads_back(spark, tmp_path, fmt):
    run = RiskRun(micro_df(spark))
    for name, df in (("rating", run.rating), ("outliers", run.outliers()), ("empty", run.rating.limit(0))):
        back = sinks.hand_off(df, str(tmp_path / name), fmt)
        assert back.schema.simpleString() == df.schema.simpleString() and rows(back) == rows(df)


def test_a_lossy_hand_off_is_refused(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, " padded ")], "a int, b string")
    with pytest.raises(sinks.HandOffError):
        sinks.hand_off(df, str(tmp_path / "x"), "csv", ignoreTrailingWhiteSpace=True)


def test_run_folder_is_removed(spark):
    import os

    with RiskRun(micro_df(spark)) as run:
        run.alert_rows.count()
        folder = run._folder.path.removeprefix("file:")
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)


def brute_limit(values, allowed):
    """Lowest occurring limit with at most ``allowed`` values above, and the widest gap up to it."""
    if allowed >= len(values):
        return (0, sum(v > 0 for v in values), None, None, None)
    limit = min(v for v in values if sum(x > v for x in values) <= allowed)
    known = sorted({v for v in values if v <= limit})
    gap = max(((b - a, a, b) for a, b in zip(known, known[1:], strict=False)), default=(None, None, None))
    return (limit, sum(v > limit for v in values), gap[1], gap[2], sum(v > gap[1] for v in values) if gap[1] is not None else None)


@pytest.mark.parametrize("budget", [{"share": 0.05}, {"share": 0.5}, {"hits": 0}, {"hits": 3}, {"hits": 10_000}])
def test_segment_limits_equal_brute_force(spark, budget):
    import random

    rng = random.Random(7)
    data = [(i, rng.choice([rng.randint(1, 50), rng.randint(1, 2**40)]), rng.choice(["Low", "High", None])) for i in range(300)] + [(999, 5, "One")]
    df = spark.createDataFrame(data, "CustomerID int, TransactionAmount long, Risk_Segment string")
    got = {r[0]: tuple(r)[1:] for r in rules.segment_limits(df, **budget).collect()}
    want = {}
    for seg in {r[2] for r in data}:
        values = [r[1] for r in data if r[2] == seg]
        allowed = budget["hits"] if "hits" in budget else len(values) * round(budget["share"] * 10000) // 10000
        want[seg] = (len(values), *brute_limit(values, allowed))
    assert got == want


def test_rolling_rows_move_once_and_equal_every_window(spark, tmp_path):
    data = [(c, s, 10 * (c or 5) + 7 * m + k * k, t, f"2024-0{m}") for c in (1, 2, 3, None) for s in ("Credit", "Debit", None) for m in (1, 2, 4, 5) if (c or 0) != m for k, t in enumerate(("FI", "RO", None))]
    store = PeriodStore(spark, str(tmp_path / "store"))
    store.load(spark.createDataFrame(data, "CustomerID int, TransactionSign string, TransactionAmount int, TransactionCountry string, period string"))
    got = store.rolling_thresholds(3)
    stored = ["2024-01", "2024-02", "2024-04", "2024-05"]
    for k, month in enumerate(stored):
        window = store.thresholds(stored[max(0, k - 2) : k + 1])
        assert rows(got.where(F.col("period") == month).drop("period")) == rows(window) != []
    # the copies for each window are made where the rows of a customer are, not before an exchange
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning" in x and "TransactionSign" in x for x in plan.splitlines()) == 1
