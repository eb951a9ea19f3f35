"""Months as the unit of loading: stored cubes, replaced one by one, read as windows.

A month's transactions are summed up once (:func:`txrisk.operators.cube.transaction_cube`) and
stored under ``period=<month>``. Loading a month again replaces it, so a repeated or corrected
delivery leaves the same state as a single one, in whatever order months come. Features and
thresholds of any window of months are merged from the stored cubes alone; the facts of old
months are never read again.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txrisk.config import DEFAULT, RiskConfig
from txrisk.operators import features as feat
from txrisk.operators.cube import MAXIMA, MINIMA, profile_of, transaction_cube
from txrisk.plans.riskrun import RiskRun
from txrisk.sources.schema import COLUMNS, CTRY, ID, SIGN, TRANSACTION_SCHEMA

PERIOD = "period"


class PeriodStore:
    """Monthly cubes below ``path``. Periods are strings that sort by time, such as ``2024-07``."""

    def __init__(self, spark: SparkSession, path: str, cfg: RiskConfig = DEFAULT):
        self.spark, self.path, self.cfg = spark, path.rstrip("/"), cfg
        cube = transaction_cube(spark.createDataFrame([], TRANSACTION_SCHEMA), cfg)
        self.schema = T.StructType([*cube.schema.fields, T.StructField(PERIOD, T.StringType())])

    def load(self, tx: DataFrame, period: str | None = None) -> None:
        """Store or replace months: the one named, or every month in the column ``period`` (no
        NULLs) of ``tx``. One pass over the delivery. Only the folders of the months delivered
        change, each in one step when all of the new cubes have been written."""
        if period is not None:
            tx = tx.select(*COLUMNS).withColumn(PERIOD, F.lit(period))
        cube = transaction_cube(tx, self.cfg, PERIOD)
        writer = cube.select(*[f.name for f in self.schema]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(PERIOD).parquet(self.path)

    def cubes(self) -> DataFrame:
        """Every stored month's cube; a condition on ``period`` prunes folders."""
        return self.spark.read.schema(self.schema).parquet(self.path)

    def cube(self, periods: Iterable[str]) -> DataFrame:
        """The cube of a window of months."""
        return merged(self.cubes().where(F.col(PERIOD).isin(list(periods))))

    def profile(self, periods: Iterable[str]) -> DataFrame:
        return profile_of(self.cube(periods), self.cfg)

    def features(self, periods: Iterable[str]) -> DataFrame:
        """All customer features over a window, from stored state alone."""
        return feat.customer_features(self.profile(periods), self.cfg)

    def thresholds(self, periods: Iterable[str]) -> DataFrame:
        return feat.sign_thresholds(self.profile(periods), self.cfg)

    def judge(self, tx: DataFrame, periods: Iterable[str]) -> DataFrame:
        """The rows of a delivery that reach their customer's threshold of the window."""
        bounds = feat.sign_bounds(self.profile(periods), self.cfg).drop("max_amt")
        return feat.alert_rows(tx, bounds)

    def run(self, tx: DataFrame, periods: Iterable[str]) -> RiskRun:
        """A rating run whose profile covers the window; ``tx`` are the facts of all its months."""
        return RiskRun(tx, self.cfg, profile=self.profile(periods))

    def _windows(self, months: int) -> DataFrame:
        """(_month, window): every stored month with each window that holds it, ``months`` rows a
        stored month at most, so it can be broadcast whatever the facts."""
        # months in order; one row a stored month, so a single window is small whatever the facts
        known = self.cubes().select(PERIOD).distinct().withColumn("_nr", F.row_number().over(Window.partitionBy().orderBy(PERIOD)))
        held = known.select(F.col(PERIOD).alias("_month"), F.explode(F.sequence("_nr", F.col("_nr") + months - 1)).alias("_nr"))
        return F.broadcast(held.join(F.broadcast(known.withColumnRenamed(PERIOD, "window")), "_nr").drop("_nr"))

    def rolling_cube(self, months: int) -> DataFrame:
        """For every stored month, the cube of it and of the stored months before it, ``months`` in
        all. Each month's cube is copied once for each window that holds it."""
        rows = self.cubes().join(self._windows(months), F.col(PERIOD) == F.col("_month"))
        return merged(rows.drop(PERIOD, "_month"), "window")

    def rolling_thresholds(self, months: int) -> DataFrame:
        """(window, customer, sign) thresholds over the ``months`` stored months up to each one.

        The cubes' rows move once, by customer and sign (a few rows a month each, however many
        facts it has): there they are added up by month and then, copied, by window. The number
        of partitions is explicit, as the copies are made after the exchange."""
        rows = self.cubes().where(F.col(ID).isNotNull() & F.col(SIGN).isNotNull() & (F.col("n_pos") > 0))
        rows = rows.select(PERIOD, ID, SIGN, "n_pos", "s_pos", "q_pos")
        rows = rows.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")), ID, SIGN)

        def added(df: DataFrame, month: str) -> DataFrame:
            return df.groupBy(month, ID, SIGN).agg(*[F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in ("n_pos", "s_pos", "q_pos")])

        held = added(rows, PERIOD).join(self._windows(months), F.col(PERIOD) == F.col("_month")).drop(PERIOD, "_month")
        profile = added(held, "window").select(
            F.struct("window", ID).alias(ID),  # a customer of a window is a customer of its own
            SIGN, F.col("n_pos").alias("n_rows"), F.col("s_pos").alias("s_amt"), F.col("q_pos").cast("decimal(30,0)").alias("q_amt"),
        )
        found = feat.sign_thresholds(profile, self.cfg)
        return found.select(F.col(f"{ID}.window").alias(PERIOD), F.col(f"{ID}.{ID}").alias(ID), *[c for c in found.columns if c != ID])

    def monthly_incoming(self) -> DataFrame:
        """(period, customer) total incoming amount from the high-risk list: the monthly rule's measure."""
        listed = F.col(CTRY).isin(list(self.cfg.high_risk_countries)) & (F.col(SIGN) == self.cfg.credit) & (F.col("n_pos") > 0)
        return self.cubes().where(listed).groupBy(PERIOD, ID).agg(F.sum("s_pos").alias("TransactionAmount"))


def merged(cubes: DataFrame, *more: str) -> DataFrame:
    """Cube rows of several months added up by customer, sign and country (and ``more``)."""
    keys = [*more, ID, SIGN, CTRY]
    parts = []
    for f in cubes.schema:
        if f.name not in (*keys, PERIOD):
            how = F.min if f.name in MINIMA else F.max if f.name in MAXIMA else F.sum
            parts.append(how(f.name).cast(f.dataType).alias(f.name))
    return cubes.groupBy(*keys).agg(*parts)
