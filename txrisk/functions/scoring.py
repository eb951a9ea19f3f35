"""Column expressions shared by the operators: bands, ratios, points, segments.

All are built-in Catalyst expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from txrisk.config import Band, RiskConfig


def band(value: Column, bands: Iterable[Band]) -> Column:
    """First band whose inclusive [low, high] holds ``value``; NULL if none (CASE without ELSE)."""
    expr = None
    for low, high, out in bands:
        cond = F.lit(True)
        if low is not None:
            cond = cond & (value >= low)
        if high is not None:
            cond = cond & (value <= high)
        expr = F.when(cond, F.lit(out)) if expr is None else expr.when(cond, F.lit(out))
    return expr


def flag(cond: Column) -> Column:
    """IIF(cond, 1, 0): a NULL condition takes the false branch."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def ratio_or_sentinel(num: Column, den: Column, sentinel: float) -> Column:
    """num / den as double, or the sentinel when the divisor is 0 (missing is already 0)."""
    return F.when(den == 0, F.lit(float(sentinel))).otherwise(num.cast("double") / den.cast("double"))


def frequency_score(num_transactions: Column, amount_sum: Column, cfg: RiskConfig) -> Column:
    """Cluster 1-6 for customers above the amount gate, NULL otherwise or in a gap."""
    return F.when(amount_sum > cfg.frequency_amount_gate, band(num_transactions, cfg.frequency_bands))


def frequency_points(score: Column, cfg: RiskConfig) -> Column:
    expr = F.when(score.isNull(), F.lit(0))
    for cluster, points in cfg.frequency_points:
        expr = expr.when(score == cluster, F.lit(points))
    return expr


def not_nordics_points(nordics_only: Column) -> Column:
    return F.when(nordics_only == 1, F.lit(0)).when(nordics_only == 0, F.lit(1))


def hrc_points(ratio: Column, cfg: RiskConfig) -> Column:
    return (
        F.when(ratio >= cfg.hrc_high_ratio, F.lit(cfg.hrc_high_points))
        .when(ratio > cfg.hrc_low_ratio, F.lit(cfg.hrc_low_points))
        .otherwise(F.lit(0))
    )


def unusual_points(num_unusual: Column, cfg: RiskConfig) -> Column:
    return band(num_unusual, cfg.unusual_bands)


def segment(total: Column, cfg: RiskConfig) -> Column:
    return band(total, cfg.segment_bands)


def square_sum(amount: Column, counted: Column) -> Column:
    """Exact sum of squares of the counted whole amounts, as decimal(30,0).

    A square is added up in three parts of 21 bits, so the aggregation works on longs (decimals
    cost several times as much a row) and holds 4 * 10^12 rows a group; the parts are put
    together once a group.
    """
    square = amount.cast("long") * amount.cast("long")
    total = None
    for shift in (42, 21, 0):
        part = F.shiftright(square, shift).bitwiseAND(F.lit((1 << 21) - 1))
        term = F.sum(F.when(counted, part)).cast("decimal(19,0)") * F.lit(1 << shift).cast("decimal(13,0)")
        total = term if total is None else total + term
    return total.cast("decimal(30,0)")


def centred(n: Column, s: Column, q: Column) -> dict[str, Column]:
    """Exact moments of a group around the whole part of its mean.

    With ``n`` rows, ``s`` = sum(x) and ``q`` = sum(x*x): ``_a`` = floor(s / n), ``_r`` =
    sum(x - a), which lies in [0, n), and ``_v`` = sum((x - a)^2). All are integers, so they
    do not depend on how the rows were split over tasks, and nothing cancels later.
    """
    n = F.nullif(n, F.lit(0).cast("long"))
    r = F.pmod(s, n)
    a = F.call_function("div", s - r, n)
    da, ds, dn = a.cast("decimal(11,0)"), s.cast("decimal(20,0)"), n.cast("decimal(20,0)")
    return {"_a": a, "_r": r, "_v": (q.cast("decimal(38,0)") - da * ds * 2 + da * da * dn).cast("decimal(38,0)")}


def threshold_columns(n: Column, cfg: RiskConfig) -> dict[str, Column]:
    """Mean, population stdev and mean + k*sigma from the columns of :func:`centred`.

    A constant group has ``_r`` = ``_v`` = 0, so all three are exact at any size; a tie such
    as 10,10,10,10,60 (mean 20, sigma 20) lands exactly on 60.
    """
    rest = F.col("_r").cast("double") / n.cast("double")
    sigma = F.sqrt(F.greatest(F.col("_v").cast("double") / n.cast("double") - rest * rest, F.lit(0.0)))
    mean = F.col("_a").cast("double") + rest
    return {
        "avg_amount_transaction": mean,
        "standard_dev": sigma,
        "threshold_single_transaction": mean + F.lit(float(cfg.sigma_multiplier)) * sigma,
    }


def alert_bounds(n: Column, threshold: Column, cfg: RiskConfig) -> dict[str, Column]:
    """Smallest whole amounts that reach (``alert_from``) and pass (``outlier_from``) mean + k*sigma.

    With y = x - a the test (n*x - s)^2 >= k^2 * (n*q - s^2) is, divided by n,
    n*y^2 - 2*y*r - k^2*v >= -(1 + k^2) * r^2 / n: integers on the left, a quotient whose
    floor (ceiling for the strict test) decides on the right. No product exceeds 38 digits
    below 10^18 rows. The double ``threshold`` is off by far less than a half, so its
    nearest integer or the next one is the bound, and the exact test picks.
    """
    k2 = cfg.sigma_multiplier**2
    x = F.round(threshold).cast("long")
    y = (x - F.col("_a")).cast("decimal(12,0)")
    r = F.col("_r").cast("decimal(19,0)")
    dn = n.cast("decimal(19,0)")
    left = (dn * y * y).cast("decimal(38,0)") - (y * r * 2).cast("decimal(38,0)") - (F.col("_v") * k2).cast("decimal(38,0)")
    spread = (r * r * (1 + k2)).cast("decimal(38,0)")
    over = F.pmod(spread, dn).cast("decimal(38,0)")
    floor = F.call_function("div", spread - over, dn)
    ceil = floor + F.when(over > 0, F.lit(1)).otherwise(F.lit(0))
    at_least_mean = dn * y >= r
    return {
        "alert_from": F.when(at_least_mean & (left >= -floor), x).otherwise(x + 1),
        "outlier_from": F.when(at_least_mean & (left > -ceil), x).otherwise(x + 1),
    }
