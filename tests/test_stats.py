"""Exact order statistics by radix select, against brute force."""

import random

import pytest

from txrisk.functions.stats import exact_median, kth_values, nearest_rank_percentiles


def _brute_nearest(vals, p):
    s = sorted(vals)
    return s[max(1, -(-int(round(p * 10000)) * len(s) // 10000)) - 1]


@pytest.mark.parametrize("dtype", ["int", "long"])
def test_median_and_percentiles_by_group(spark, dtype):
    rng = random.Random(7)
    span = 2**31 - 1 if dtype == "int" else 2**62
    rows = []
    groups = {"a": 1, "b": 2, "c": 57, None: 300, "hot": 2000}
    for g, n in groups.items():
        for _ in range(n):
            # wide range, negatives, and repeated values (hot copies)
            v = rng.choice([rng.randint(-span, span), rng.randint(-5, 5), 42])
            rows.append((g, v))
    rows.append(("a", None))
    df = spark.createDataFrame(rows, f"g string, v {dtype}")
    med = {r["g"]: r["median"] for r in exact_median(df, ["g"], "v").collect()}
    pct = {r["g"]: (r["p50"], r["p90"], r["p95"]) for r in nearest_rank_percentiles(df, ["g"], "v", [0.5, 0.9, 0.95]).collect()}
    for g in groups:
        vals = [v for gg, v in rows if gg == g and v is not None]
        s = sorted(vals)
        assert med[g] == pytest.approx((s[(len(s) - 1) // 2] + s[len(s) // 2]) / 2, rel=1e-15), g
        assert pct[g] == tuple(_brute_nearest(vals, p) for p in (0.5, 0.9, 0.95)), g


def test_global_median_without_groups(spark):
    vals = [5, 1, 9, 9, 9, 2, -4, 100]
    df = spark.createDataFrame([(v,) for v in vals], "v int")
    assert exact_median(df, [], "v").first()["median"] == 7.0
    assert kth_values(df, [], "v", {"first": "1", "last": "n"}).first()[1:] == (-4, 100)
