"""Customer risk rating: wide feature table, points, total score and segment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txrisk.config import DEFAULT, RiskConfig
from txrisk.functions.scoring import flag, frequency_points, hrc_points, not_nordics_points, segment, unusual_points
from txrisk.sources.schema import ID

POINT_COLUMNS = (
    "TransactionFrequencyScore",
    "NotNordicsOnlyFlag",
    "HRCFlag",
    "RussiaFlag",
    "HighOutflowsFlag",
    "CDRatioFlag",
    "One_to_Many_Risk_Flag",
    "Many_to_One_Risk_Flag",
    "UnusualTransactionsScore",
)


def risk_features_wide(features: DataFrame, alerts: DataFrame) -> DataFrame:
    """Customer base with every feature group (``customer_features``) and the alert counts.

    Both sides come out of an aggregate on CustomerID, so they are already hash
    partitioned on it and the left join adds no exchange.
    """
    a = alerts.select(
        F.col(ID),
        F.col("total_num_transactions").alias("ual_total_num_transactions"),
        F.col("num_unusual_transactions").alias("ual_num_unusual_transactions"),
    )
    return features.join(a, on=ID, how="left")


def risk_points(wide: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Nine point columns per customer. Some rules have no ELSE, so NULL inputs stay NULL."""
    c = F.col
    points = {
        "TransactionFrequencyScore": frequency_points(c("freq_ScoreFrequency"), cfg),
        "NotNordicsOnlyFlag": not_nordics_points(c("ctry_NordicsOnly_check")),
        "HRCFlag": hrc_points(c("ctry_HRC_Trnsactions_Ratio"), cfg),
        "RussiaFlag": F.when(c("ctry_Russia_check") == 1, F.lit(cfg.russia_points)).otherwise(F.lit(0)),
        "HighOutflowsFlag": flag(c("cdr_CDRatio") <= cfg.high_outflow_ratio),
        "CDRatioFlag": flag(c("cdr_CDRatio_Around_1_flag") == 1),
        "One_to_Many_Risk_Flag": flag(c("cdt_OtMRatio_flag") == 1),
        "Many_to_One_Risk_Flag": flag(c("cdt_MtORatio_flag") == 1),
        "UnusualTransactionsScore": unusual_points(c("ual_num_unusual_transactions"), cfg),
    }
    return wide.select(c(ID), *[points[name].alias(name) for name in POINT_COLUMNS])


def risk_rating(points: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Points plus ``TOTAL_Score`` (plain sum: any NULL point makes it NULL) and ``Risk_Segment``."""
    total = None
    for name in POINT_COLUMNS:
        total = F.col(name) if total is None else total + F.col(name)
    return points.withColumn("TOTAL_Score", total).withColumn("Risk_Segment", segment(F.col("TOTAL_Score"), cfg))


def segment_summary(rating: DataFrame) -> DataFrame:
    """Customers and their share (percent) per segment.

    The share needs the grand total; after the aggregate there are at most five rows,
    so a window over all of them is bounded.
    """
    per = rating.groupBy("Risk_Segment").agg(F.count(F.lit(1)).alias("num_customers"))
    total = F.sum("num_customers").over(Window.partitionBy())
    return per.withColumn("share_pct", F.col("num_customers") * F.lit(100.0) / total)


def customer_rating(rating: DataFrame, customer_id: int) -> DataFrame:
    """The rating row of one customer (a lookup)."""
    return rating.where(F.col(ID) == customer_id)
