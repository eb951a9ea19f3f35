"""Connected components of an edge table by alternating large-star and small-star rounds
(Kiveris et al., 2014). Every round is two grouped minima and two joins; nothing of the
graph reaches the driver but a count and a checksum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm.shared import stored


def _both_ways(e: DataFrame) -> DataFrame:
    return e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(e: DataFrame) -> DataFrame:
    both = _both_ways(e)
    m = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    m = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(m, "u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(m.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(doc_id, component): the smallest id reachable, for every id with an edge (u, v)."""
    e, before = stored(edges.select("u", "v").where("u <> v").distinct(), "edges"), None
    while True:
        e = stored(_small_star(_large_star(e)), "edges")
        row = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == before or not row[0]:
            break
        before = tuple(row)
    return e.select(F.col("u").alias("doc_id"), F.col("v").alias("component")).union(e.select(F.col("v").alias("doc_id"), F.col("v").alias("component")).distinct())
