"""Where intermediate tables go, and shipping of the package to Python workers."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from txrisk.session import ensure_checkpoint_dir


def ship(spark: SparkSession) -> None:
    """Send the package's code to the executors' Python workers, once for each context."""
    sc = spark.sparkContext
    if getattr(sc, "_txrisk_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="txrisk-code-")) / "txrisk_code.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    sc.addPyFile(str(target))
    sc._txrisk_shipped = True


def workspace(spark: SparkSession, tag: str) -> str:
    """A new folder below the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet to shared storage and read it back: cuts the lineage, so a
    lost executor costs a re-read, and keeps column pruning for every later reader."""
    spark = df.sparkSession
    path = workspace(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Of what runs inside, the shuffle files go when its query ends, not when the driver
    happens to collect its garbage (a setting of Spark 4.1; others ignore it)."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc32_mod(col, k: int):
    """``crc32(id as text) mod k``, JVM side."""
    from pyspark.sql import functions as F

    return F.crc32(col.cast("string").cast("binary")) % k
