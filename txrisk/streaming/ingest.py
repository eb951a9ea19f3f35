"""Incremental load: new delimited files in a folder are parsed, checked and appended.

The batch loader's parser and quarantine rules run unchanged on a file stream. The
parquet file sink with a checkpoint location is exactly-once: a restarted query (or a
lost executor) neither drops nor duplicates a file's lines. ``availableNow`` processes
the backlog in bounded micro-batches and stops, which suits a monthly drop of files.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txrisk.config import DEFAULT, RiskConfig
from txrisk.sources.ingest import STATUS, STREAM_LOG, checked_lines, path_exists
from txrisk.sources.schema import AMT


def stream_transactions(
    spark: SparkSession, src_dir: str, sep: str = ";", cfg: RiskConfig = DEFAULT, max_files_per_trigger: int = 1000
) -> DataFrame:
    """Streaming DataFrame over the files of ``src_dir`` with a ``load_status`` column."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(src_dir)
    return checked_lines(lines, sep, cfg).withColumn(STATUS, F.coalesce(F.col(STATUS), F.lit("good")))


def start_ingest(
    spark: SparkSession,
    src_dir: str,
    out_dir: str,
    checkpoint_location: str | None = None,
    sep: str = ";",
    cfg: RiskConfig = DEFAULT,
    available_now: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Append parsed lines to ``out_dir/load_status=<good|reason>`` (read back with
    :func:`txrisk.sources.ingest.read_ingested`). The query's checkpoint defaults to a
    folder inside ``out_dir``, so a later call goes on where the last one ended. A folder
    with files that no stream wrote is refused."""
    location = checkpoint_location or f"{out_dir.rstrip('/')}/_checkpoint"
    if path_exists(spark, out_dir) and not path_exists(spark, f"{out_dir}/{STREAM_LOG}") and not path_exists(spark, location):
        raise ValueError(f"{out_dir} holds other files; a stream written there would hide them")
    writer = (
        stream_transactions(spark, src_dir, sep, cfg)
        .writeStream.format("parquet")
        .option("path", out_dir)
        .option("checkpointLocation", location)
        .partitionBy(STATUS)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def start_completeness_log(
    spark: SparkSession,
    src_dir: str,
    out_dir: str,
    checkpoint_location: str | None = None,
    sep: str = ";",
    cfg: RiskConfig = DEFAULT,
    available_now: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Import completeness per micro-batch of new files: lines read, lines quarantined,
    and the absolute amount of the good lines.

    The counts are one global aggregate per batch, computed by the cluster. Each batch
    writes ``out_dir/batch_id=<n>`` in overwrite mode, so a batch replayed after a
    failure replaces its own record instead of adding a second one.
    """
    location = checkpoint_location or f"{out_dir.rstrip('/')}/_checkpoint"
    good = F.col(STATUS) == "good"

    def record(batch: DataFrame, batch_id: int) -> None:
        batch.agg(
            F.count(F.lit(1)).alias("total_records"),
            F.count(F.when(~good, 1)).alias("quarantined_records"),
            F.sum(F.when(good, F.abs(F.col(AMT)))).alias("total_abs_amount"),
        ).write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch_id={batch_id}")

    writer = stream_transactions(spark, src_dir, sep, cfg).writeStream.foreachBatch(record).option(
        "checkpointLocation", location
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
