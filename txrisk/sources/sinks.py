"""Result hand-off: every result is written by the cluster, never pulled to the driver."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class HandOffError(RuntimeError):
    """A written result does not read back as it was computed."""


def write_result(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", **options) -> None:
    """Write a result table. ``fmt='csv'`` writes a header line and ``;`` separators
    (the file form the source used), for spreadsheet hand-off."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True).option("sep", options.pop("sep", ";"))
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.format(fmt).save(path)


def read_result(df: DataFrame, path: str, fmt: str = "parquet", sep: str = ";") -> DataFrame:
    """A written result, with the columns and types of ``df``."""
    reader = df.sparkSession.read.schema(df.schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("sep", sep).option("mode", "FAILFAST")
    return reader.format(fmt).load(path)


def _digest(df: DataFrame) -> list[Column]:
    """Row count and an order-free hash: the sum of the rows' hashes, NULLs told apart."""
    cells = [x for c in df.columns for x in (F.col(c), F.col(c).isNull())]
    return [F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*cells).cast("decimal(20,0)")).alias("hash")]


def hand_off(df: DataFrame, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Write ``df`` and read it back; raises :class:`HandOffError` unless rows and hash agree.

    The digest of what was computed is observed while it is written, so the result is computed
    once. Returns the table read back.
    """
    seen = Observation(f"hand-off-{uuid.uuid4().hex}")
    write_result(df.observe(seen, *_digest(df)), path, fmt, **options)
    back = read_result(df, path, fmt, options.get("sep", ";"))
    got, want = back.agg(*_digest(back)).first().asDict(), seen.get
    if got != want:
        raise HandOffError(f"{path}: {want} were written and {got} read back")
    return back
