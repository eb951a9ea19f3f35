"""Measures of the derived fixtures (FIXTURES.md §3-§4) and invariants of the rating."""

import pytest
from conftest import SF_MID, SF_SMALL
from pyspark.sql import functions as F

from txrisk.operators import explore as ex
from txrisk.operators import quality as q
from txrisk.plans.riskrun import RiskRun
from txrisk.sources.fixtures import tx_lines, tx_orders


def _counts(df, col, keys):
    got = {r[0]: r[1] for r in df.groupBy(col).count().collect()}
    return tuple(got.get(k, 0) for k in keys)


SEGMENTS = ("Low", "Medium-Low", "Medium-High", "High")
LINES = {
    SF_SMALL: dict(rows=6000, customers=150, abs_amount=31699709, median=5271.5, id0=41, q7=1, q8=0, e5=536,
                   e9=55, e10=33, sf=(0, 2, 10, 0, 138, 0), seg=(12, 93, 42, 3), r13=(18, 16), r15=(1, 10, 0),
                   r17=(1, 1, 0)),
    SF_MID: dict(rows=60000, customers=1500, abs_amount=317952739, median=5296.0, id0=49, q7=6, q8=12, e5=4835,
                 e9=493, e10=266, sf=(2, 20, 79, 16, 1383, 0), seg=(72, 1020, 359, 49), r13=(202, 177),
                 r15=(27, 59, 1), r17=(27, 3, 0)),
}


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_tx_lines_measures(spark, sf):
    exp = LINES[sf]
    tx = tx_lines(spark, sf)
    c = q.import_completeness(tx).first()
    assert (c["total_records"], c["total_abs_amount"]) == (exp["rows"], exp["abs_amount"])
    assert q.amount_skew(tx).first()["median_amount"] == exp["median"]
    assert q.customer_history(tx, 0).count() == exp["id0"]
    assert q.concentration_by_customer_country(tx).count() == exp["q7"]
    assert q.concentration_by_amount(tx).count() == exp["q8"]
    assert ex.customers_with_country(tx, ["RO"]).count() == exp["e5"]
    assert ex.round_amounts(tx, 100).count() == exp["e9"]
    assert ex.round_amounts(tx, 100, 5000).count() == exp["e10"]
    run = RiskRun(tx)
    assert run.rating.count() == exp["customers"]
    assert _counts(run.wide, "freq_ScoreFrequency", (1, 2, 3, 4, 5, None)) == exp["sf"]
    assert _counts(run.rating, "Risk_Segment", SEGMENTS) == exp["seg"]
    out = run.outliers()
    assert (out.count(), out.select("CustomerID").distinct().count()) == exp["r13"]
    assert _counts(run.incoming, "Risk_Segment", SEGMENTS[::-1][:3]) == exp["r15"]
    assert _counts(run.rule_hits, "Risk_Segment", SEGMENTS[::-1][:3]) == exp["r17"]


ORDERS = {
    SF_SMALL: dict(rows=1500, sf=(2, 114, 34, 0, 0, 0), e11=(2, 114, 34, 0, 0), seg=(87, 53, 9, 1),
                   hrc=(131, 19, 0), unusual=(134, 16), r13=(3, 3), r15=(0, 2, 9)),
    SF_MID: dict(rows=15000, sf=(12, 1162, 310, 3, 3, 10), e11=(20, 1162, 312, 3, 3), seg=(908, 496, 93, 3),
                 hrc=(1366, 133, 1), unusual=(1292, 208), r13=(66, 66), r15=(0, 26, 55)),
}


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_tx_orders_measures(spark, sf):
    exp = ORDERS[sf]
    tx = tx_orders(spark, sf)
    assert tx.count() == exp["rows"]
    hist = {r[0]: r[1] for r in ex.frequency_histogram(tx).collect()}
    assert tuple(hist.get(k, 0) for k in (1, 2, 3, 4, 5)) == exp["e11"]
    run = RiskRun(tx)
    assert _counts(run.wide, "freq_ScoreFrequency", (1, 2, 3, 4, 5, None)) == exp["sf"]
    assert _counts(run.rating, "Risk_Segment", SEGMENTS) == exp["seg"]
    assert _counts(run.rating, "HRCFlag", (0, 1, 3)) == exp["hrc"]
    assert _counts(run.rating, "UnusualTransactionsScore", (0, 1)) == exp["unusual"]
    out = run.outliers()
    assert (out.count(), out.select("CustomerID").distinct().count()) == exp["r13"]
    assert _counts(run.incoming, "Risk_Segment", SEGMENTS[::-1][:3]) == exp["r15"]


def test_rating_invariants(spark):
    tx = tx_orders(spark, SF_MID)
    run = RiskRun(tx)
    r = run.rating.join(run.wide.select("CustomerID", "ctry_RU"), "CustomerID")
    assert r.where((F.col("TOTAL_Score") < 0) | (F.col("TOTAL_Score") > 15)).count() == 0
    assert r.where((F.col("ctry_RU") > 0) & (F.col("TOTAL_Score") < 4)).count() == 0
    assert run.incoming.where(F.col("Risk_Segment") == "Low").count() == 0
    summary = run.segment_summary.agg(F.sum("num_customers"), F.sum("share_pct")).first()
    assert summary[0] == run.rating.count()
    assert summary[1] == pytest.approx(100.0)
    assert run.outliers().where(F.col("transaction_unusual_alert") != 1).count() == 0


def test_rating_independent_of_partitioning(spark):
    tx = tx_lines(spark, SF_SMALL)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = set()
    try:
        for n in (1, 4, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            run = RiskRun(tx)
            seen.add((
                tuple(sorted(tuple(x) for x in run.rating.collect())),
                tuple(sorted(tuple(x) for x in run.thresholds.collect())),
            ))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(seen) == 1


def test_items_meet_their_order_in_three_columns(spark, tmp_path):
    """The join of items and orders moves key, amount and one code; nulls and odd rows as in SQL."""
    import duckdb

    from txrisk.sources.fixtures import TX_LINES_SQL

    items = [(o, p, n, x, f) for o in (1, 2, 3, 7, 214, 431, None) for p in (1, 2, 3, None) for n, x, f in ((1, 105.5, "R"), (2, None, "N"), (None, 99.0, None), (6, 20.0, "A"))]
    items += [(k // 7, 5, k % 7, 1234.5, "R") for k in (1507, 3011, 2000, 2003, 2004, 2005, 2006, 5013, 5017)]
    spark.createDataFrame(items, "l_orderkey long, l_partkey long, l_linenumber int, l_extendedprice double, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(k, k % 3 or None) for k in {i[0] for i in items if i[0]}] + [(1, 9), (None, 4)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    tx = tx_lines(spark, str(tmp_path))
    con = duckdb.connect()
    for t in ("lineitem", "orders"):
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    got, want = tx.collect(), con.execute(TX_LINES_SQL).fetchall()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want)) and {r[3] for r in got} >= {"RO", "RU", "PL", "CY", "NO", None}
    node = tx._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Join":
        node = node.children().head()
    assert node.children().head().output().size() == 3
