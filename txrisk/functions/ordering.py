"""Deterministic result order.

A report sorted only on a non-unique key (a count, a customer) is not reproducible, and
range partitioning puts every tie into one task. Adding the remaining output columns as
tie-breakers gives a total order over distinct rows, so ties spread over tasks. Exact copies of
a row are the one tie left: they are collapsed to (row, blocks of copies), sorted as such and
written out again in order. No row carries an id made while the query runs, so a repeated task
yields the same rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Copies written in one go: more copies of a row are several sort rows.
COPY_BLOCK = 65_536


def total_order(df: DataFrame, *first: str, desc: Iterable[str] = (), copies: bool = False) -> DataFrame:
    """Sort on ``first`` (names in ``desc`` descending), then on every other column. ``copies``
    says that exact copies of a row may occur (results of a grouping have none)."""
    desc = set(desc)
    keys = [F.col(c).desc_nulls_last() if c in desc else F.col(c).asc_nulls_first() for c in first]
    keys += [F.col(c).asc_nulls_first() for c in df.columns if c not in first]
    if not copies:
        return df.orderBy(*keys)
    count, block = F.col("_copies"), F.col("_block")
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    last = F.call_function("div", count - 1, F.lit(COPY_BLOCK).cast("long"))
    rows = rows.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    here = F.least(F.lit(COPY_BLOCK).cast("long"), count - block * COPY_BLOCK)
    written = rows.withColumn("_copies", here).orderBy(*keys, block)
    return written.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(*df.columns)
