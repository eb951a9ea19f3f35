"""Load the delimited transaction file, quarantine bad lines, and derive the clean view.

File form: ``;`` between fields, one row per line, no header, e.g. ``8816;Credit;5001;FI``.
A line is quarantined when it does not parse against the declared schema (wrong type,
missing or surplus field), breaks a declared length (sign > 10, country > 2 characters)
or has a sign other than the two the rules know (an empty sign loads as NULL).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.config import DEFAULT, RiskConfig
from txrisk.sources.schema import AMT, COLUMNS, CORRUPT, CTRY, READ_SCHEMA, SIGN

STATUS = "load_status"


#: A folder that a streaming query writes has this log, and readers follow it alone.
STREAM_LOG = "_spark_metadata"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def parse_lines(lines: DataFrame, sep: str) -> DataFrame:
    """Columns of the read schema from text lines (column ``value``). Every line is parsed
    in full, so whether it is bad never depends on the columns that a query reads."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in READ_SCHEMA.fields)
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    full = lines.where(F.trim("value") != "")  # a file's blank lines are no records
    return full.select(F.from_csv("value", schema, options).alias("r")).select("r.*")


def quarantine_reason(cfg: RiskConfig = DEFAULT) -> Column:
    """NULL for a good row, else why the row is quarantined."""
    return (
        F.when(F.col(CORRUPT).isNotNull(), F.lit("unparsable"))
        .when(F.length(SIGN) > cfg.max_sign_length, F.lit("sign too long"))
        .when(~F.col(SIGN).isin(cfg.credit, cfg.debit), F.lit("unknown sign"))
        .when(F.length(CTRY) > cfg.max_country_length, F.lit("country too long"))
    )


def normalize(df: DataFrame) -> DataFrame:
    """Optional: compare strings like a case-insensitive, blank-trimming collation would."""
    return df.withColumns({SIGN: F.initcap(F.trim(SIGN)), CTRY: F.upper(F.trim(CTRY))})


def checked_lines(lines: DataFrame, sep: str = ";", cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Parsed text lines (column ``value``) with a ``load_status`` column (NULL = good)."""
    df = parse_lines(lines, sep)
    if cfg.normalize_strings:
        df = normalize(df)
    return df.withColumn(STATUS, quarantine_reason(cfg))


def load_with_status(spark: SparkSession, path: str, sep: str = ";", cfg: RiskConfig = DEFAULT) -> DataFrame:
    """All lines of the files with their ``load_status``. One scan serves both outputs."""
    return checked_lines(spark.read.text(path), sep, cfg)


def read_transactions(
    spark: SparkSession, path: str, sep: str = ";", cfg: RiskConfig = DEFAULT
) -> tuple[DataFrame, DataFrame]:
    """(good rows with the declared schema, quarantined rows with raw text and reason)."""
    df = load_with_status(spark, path, sep, cfg)
    good = df.where(F.col(STATUS).isNull()).select(*COLUMNS)
    bad = df.where(F.col(STATUS).isNotNull()).select(*COLUMNS, CORRUPT, STATUS)
    return good, bad


def ingest_transactions(spark: SparkSession, path: str, out: str, sep: str = ";", cfg: RiskConfig = DEFAULT) -> None:
    """Parse once and write good and quarantined lines to ``out/load_status=...`` parquet.

    A single scan and a single write job: the status is a partition column, so good
    rows land under ``load_status=good`` and bad ones under their reason.
    """
    df = load_with_status(spark, path, sep, cfg).withColumn(STATUS, F.coalesce(F.col(STATUS), F.lit("good")))
    if path_exists(spark, f"{out}/{STREAM_LOG}"):
        raise ValueError(f"{out} belongs to a streaming ingest; a batch written there would not be read back")
    df.write.mode("overwrite").partitionBy(STATUS).parquet(out)


def read_ingested(spark: SparkSession, out: str) -> DataFrame:
    """Good rows written by :func:`ingest_transactions` (partition pruning skips the rest)."""
    return spark.read.parquet(out).where(F.col(STATUS) == "good").select(*COLUMNS)


def clean(tx: DataFrame) -> DataFrame:
    """The clean view: only rows with a positive amount (NULL amounts drop out too)."""
    return tx.where(F.col(AMT) > 0)
