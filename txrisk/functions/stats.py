"""Exact order statistics (median, percentiles) without gathering a group in one task.

Spark's exact ``percentile`` keeps a map of every distinct value of a group in the
task that finishes the group, and a global median is one group over the whole table. Here the values are first counted per
distinct value (partial aggregation shrinks hot values and exact copies), then each
wanted rank is located by radix select: a histogram over the high bits finds the
bucket holding the rank, the next bits refine inside that bucket, and so on. A window
never sees more than 2**22 rows of one group, whatever the table size, and every step
is a lazy DataFrame operation: no collect, no cross join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TARGET = "_target"
_RANK = "_rank"


def _shifts(dtype: T.DataType) -> list[int]:
    # Arithmetic right shift is floor division by 2**s, so it keeps the order of
    # negative values too. 16 bits per level for ints, 21-22 bits for longs.
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
        return [16, 0]
    return [42, 21, 0]


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], take: list[str]) -> DataFrame:
    # Null-safe equality on every key: a NULL group is a group, and no IsNotNull filter is
    # inferred and pushed into the histogram, so every level reads the same histogram
    # subtree and its shuffle is reused instead of recomputed.
    lf, rt = left.alias("_l"), right.alias("_r")
    cond = [F.col(f"_l.{k}").eqNullSafe(F.col(f"_r.{k}")) for k in keys]
    return lf.join(rt, cond, "inner").select("_l.*", *[F.col(f"_r.{c}") for c in take])


def value_counts(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """(groups, ``_v``, ``_c``): the histogram that the order statistics read."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*groups, F.col(value).cast("long").alias("_v"))
    return counted.agg(F.count(F.lit(1)).alias("_c"))


def kth_values(df: DataFrame, groups: Sequence[str], value: str, targets: dict[str, str], hist: DataFrame | None = None) -> DataFrame:
    """For each group, the value at each 1-based rank of ``targets``; ``hist`` is the kept
    :func:`value_counts` where there is one (``df`` then gives the value's type only).

    ``targets`` maps an output name to a SQL expression of ``n`` (the group's count of
    non-null values), e.g. ``{"lo": "(n + 1) div 2"}``. Returns the group columns,
    ``n`` and one long column per target. A NULL group is a group of its own.
    """
    groups = list(groups)
    shifts = _shifts(df.schema[value].dataType)
    keys = [f"_k{i}" for i in range(len(shifts))]
    hist = value_counts(df, groups, value) if hist is None else hist
    hist = hist.withColumns({k: F.shiftright("_v", s) if s else F.col("_v") for k, s in zip(keys, shifts)})
    rank_structs = F.array(*[F.struct(F.lit(name).alias(_TARGET), F.expr(e).cast("long").alias(_RANK)) for name, e in targets.items()])

    wanted = None
    for level, key in enumerate(keys):
        parents = keys[:level]
        if level == 0:
            h = hist.groupBy(*groups, key).agg(F.sum("_c").alias("_c"))
            part = groups
        else:
            h = _join_null_safe(hist, wanted, groups + parents, ["n", _TARGET, _RANK])
            part = groups + [_TARGET]
            h = h.groupBy(*part, "n", _RANK, *parents, key).agg(F.sum("_c").alias("_c"))
        running = Window.partitionBy(*part).orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        h = h.withColumn("_end", F.sum("_c").over(running))
        if level == 0:
            # group size and the wanted ranks, one row per (bucket, target)
            h = h.withColumn("n", F.sum("_c").over(Window.partitionBy(*part)))
            h = h.withColumn("_t", F.explode(rank_structs)).select("*", "_t.*").drop("_t")
        start = F.col("_end") - F.col("_c")
        h = h.where((start < F.col(_RANK)) & (F.col(_RANK) <= F.col("_end")))
        wanted = h.select(*groups, "n", _TARGET, *parents, key, (F.col(_RANK) - start).alias(_RANK))

    last = keys[-1]
    return wanted.groupBy(*groups).agg(
        F.first("n").alias("n"),
        *[F.max(F.when(F.col(_TARGET) == name, F.col(last))).alias(name) for name in targets],
    )


def exact_median(df: DataFrame, groups: Sequence[str], value: str, name: str = "median", hist: DataFrame | None = None) -> DataFrame:
    """Median as the mean of the two middle values (the middle one when the count is odd)."""
    res = kth_values(df, groups, value, {"_lo": "(n + 1) div 2", "_hi": "n div 2 + 1"}, hist)
    return res.select(*groups, "n", ((F.col("_lo") + F.col("_hi")) / F.lit(2.0)).alias(name))


def percentile_name(p: float, prefix: str = "p") -> str:
    pct = round(p * 100, 4)
    return f"{prefix}{int(pct)}" if pct == int(pct) else f"{prefix}{pct:g}".replace(".", "_")


def nearest_rank_percentiles(df: DataFrame, groups: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """Nearest-rank percentile: the smallest value with at least ``p*n`` values at or below it.

    The rank ceil(p*n) is computed in integers (p in steps of 1/10000), so float error
    cannot move it. Columns are named ``p50``, ``p90``, ... .
    """
    targets = {}
    for p in probs:
        basis = int(round(p * 10000))
        targets[percentile_name(p)] = f"greatest(1, (n * {basis} + 9999) div 10000)"
    return kth_values(df, groups, value, targets).drop("n")


def exact_moments(hist: DataFrame) -> DataFrame:
    """One row of exact sums over a histogram (``_v``, ``_c``), from which mean and skewness follow.

    Sums of the values and their powers are whole numbers (decimals), so the result does not
    depend on how rows were split. ``n``, ``s1``, ``s2``, ``s3``.
    """
    v = F.col("_v").cast("decimal(19,0)")
    c = F.col("_c").cast("decimal(19,0)")

    def power_sum(x: Column) -> Column:
        return F.sum(x.cast("decimal(38,0)"))

    return hist.agg(F.sum("_c").alias("n"), power_sum(v * c).alias("s1"), power_sum(v * v * c).alias("s2"), power_sum(v * v * v * c).alias("s3"))


def consecutive_values(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """(groups, ``low``, ``high``): every two neighbouring distinct values of each group.

    Values are split by their high digits, level by level: neighbours within a bucket come from a
    window over that bucket, neighbours across buckets from the buckets' least and largest
    values one level up. A window sees at most 2**22 rows, whatever the group's size.
    """
    groups = list(groups)
    level = df.where(F.col(value).isNotNull()).groupBy(*groups, F.col(value).cast("long").alias("low"))
    level = level.agg(F.first(F.col(value).cast("long")).alias("high"))
    pairs = None
    for shift in [*(s for s in reversed(_shifts(df.schema[value].dataType)) if s), None]:
        keys = groups if shift is None else [*groups, "_bucket"]
        spread = level if shift is None else level.withColumn("_bucket", F.shiftright("low", shift))
        # a row is a bucket's least and largest value; the gap to the row before lies between them
        before = F.lag("high").over(Window.partitionBy(*keys).orderBy("low"))
        here = spread.withColumn("_before", before).where(F.col("_before").isNotNull())
        here = here.select(*groups, F.col("_before").alias("low"), F.col("low").alias("high"))
        pairs = here if pairs is None else pairs.unionByName(here)
        if shift is not None:
            level = spread.groupBy(*keys).agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("_bucket")
    return pairs
