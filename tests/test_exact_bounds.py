"""Thresholds and alert bounds against whole-number arithmetic, at sums far above 2^53."""

import random
from decimal import Decimal

import pytest

from txrisk.config import RiskConfig
from txrisk.operators import features as feat

SCHEMA = "CustomerID int, TransactionSign string, n_rows bigint, s_amt bigint, q_amt decimal(30,0)"


def _passes(n, s, q, x, strict, k=2):
    d, var = n * x - s, n * q - s * s
    return d >= 0 and (d * d > k * k * var if strict else d * d >= k * k * var)


def _first(n, s, q, strict, k=2):
    """Smallest whole x that passes, by bisection from the mean."""
    lo = hi = s // n
    while not _passes(n, s, q, hi, strict, k):
        hi = hi * 2 + 1
    lo -= 1
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if _passes(n, s, q, mid, strict, k) else (mid, hi)
    return hi


def _moments(values):
    """n, s, q of (value, count) pairs."""
    return (sum(c for _, c in values), sum(v * c for v, c in values), sum(v * v * c for v, c in values))


def _profile(spark, groups):
    rows = [(i, "Credit", n, s, Decimal(q)) for i, (n, s, q) in enumerate(groups)]
    return spark.createDataFrame(rows, SCHEMA)


def _random_groups(seed, count=200):
    rng = random.Random(seed)
    for _ in range(count):
        big = rng.choice([10, 10**4, 10**9])
        yield _moments([(rng.randint(1, 2 ** rng.randint(1, 30)), rng.randint(1, big)) for _ in range(rng.randint(1, 5))])


@pytest.mark.parametrize("k", [1, 2, 3])
def test_bounds_equal_whole_number_test(spark, k):
    groups = list(_random_groups(k)) + [_moments([(10, 4), (60, 1)]), _moments([(10, 4 * 10**9), (60, 10**9)])]
    got = feat.sign_bounds(_profile(spark, groups), RiskConfig(sigma_multiplier=k)).collect()
    assert len(got) == len(groups)
    for r in got:
        n, s, q = groups[r["CustomerID"]]
        assert (r["alert_from"], r["outlier_from"]) == (_first(n, s, q, False, k), _first(n, s, q, True, k)), (n, s, q)


def test_constant_groups_alert_and_are_no_outliers_at_any_size(spark):
    rng = random.Random(5)
    cases = [(505782127, 2484771968)] + [(rng.randint(1, 2**31 - 1), rng.randint(10**9, 4 * 10**9)) for _ in range(300)]
    groups = [_moments([case]) for case in cases]
    profile = _profile(spark, groups)
    for r in feat.sign_thresholds(profile).collect():
        value = float(cases[r["CustomerID"]][0])
        assert (r["avg_amount_transaction"], r["standard_dev"], r["threshold_single_transaction"]) == (value, 0.0, value)
    for r in feat.sign_bounds(profile).collect():
        value = cases[r["CustomerID"]][0]
        assert (r["alert_from"], r["outlier_from"]) == (value, value + 1)


def test_hot_group_of_a_trillion_rows(spark):
    groups = [_moments([(1, 10**12), (9000, 10**11)]), _moments([(3, 10**12), (4, 10**12)])]
    for r in feat.sign_bounds(_profile(spark, groups)).collect():
        n, s, q = groups[r["CustomerID"]]
        assert (r["alert_from"], r["outlier_from"]) == (_first(n, s, q, False), _first(n, s, q, True))


def test_small_groups_can_be_left_out(spark):
    profile = _profile(spark, [_moments([(5, 2)]), _moments([(5, 3)])])
    assert [r["CustomerID"] for r in feat.sign_bounds(profile, RiskConfig(min_group_size=3)).collect()] == [1]


@pytest.mark.parametrize("k", [1, 2, 3])
def test_the_estimate_rules_out_no_group_that_reaches_its_bound(spark, k):
    rng = random.Random(10 + k)
    values = [[(rng.randint(1, 2 ** rng.randint(1, 31) - 1), rng.randint(1, 10**9)) for _ in range(rng.randint(1, 4))] for _ in range(300)]
    # constant groups and groups that end exactly on their bound
    values += [[(2**31 - 1, 4 * 10**9)], [(505782127, 2484771968)], [(10, 4), (60, 1)], [(10, 4 * 10**9), (60, 10**9)], [(7, 1)]]
    rows = [(i, "Credit", *_moments(v)[:2], Decimal(_moments(v)[2]), max(x for x, _ in v)) for i, v in enumerate(values)]
    profile = spark.createDataFrame(rows, SCHEMA + ", max_amt int")
    cfg = RiskConfig(sigma_multiplier=k)
    want = {i for i, v in enumerate(values) if max(x for x, _ in v) >= _first(*_moments(v), False, k)}
    assert {r["CustomerID"] for r in feat.reached_bounds(profile, cfg).collect()} == want and len(want) > 5
