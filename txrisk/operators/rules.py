"""Transactions outside a customer's own pattern, and the high-risk-country rule."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.config import DEFAULT, RiskConfig
from txrisk.functions.ordering import total_order
from txrisk.functions.scoring import alert_bounds, centred, threshold_columns
from txrisk.functions.stats import consecutive_values, kth_values, nearest_rank_percentiles, percentile_name
from txrisk.operators.features import with_bounds
from txrisk.sources.schema import AMT, CTRY, ID, SIGN

OUTLIER_ORDER = ("deviation_amount", ID, SIGN, AMT, CTRY)


def threshold_breaches(alerts: DataFrame, *more: str) -> DataFrame:
    """Clean rows strictly above their customer's threshold, with threshold and deviation,
    from the kept :func:`txrisk.operators.features.alert_rows`."""
    thr = F.col("threshold_single_transaction")
    deviation = (thr - F.col(AMT)).alias("deviation_amount")
    return alerts.where("above").select(ID, SIGN, AMT, CTRY, thr, F.lit(1).alias("transaction_unusual_alert"), deviation, *more)


def with_rating(breaches: DataFrame, rating: DataFrame) -> DataFrame:
    """Attach each customer's segment and total score."""
    return breaches.join(rating.select(ID, "Risk_Segment", "TOTAL_Score"), ID, "left")


def outlier_transactions(alerts: DataFrame, rating: DataFrame, order: bool = True) -> DataFrame:
    """Clean rows strictly above their customer's threshold, with the customer's rating.

    Only alert rows meet the rating. Sorted by deviation (most negative first) when ``order``;
    ties are broken on the row values so the order is total.
    """
    out = threshold_breaches(with_rating(alerts.where("above"), rating), "Risk_Segment", "TOTAL_Score")
    return total_order(out, *OUTLIER_ORDER, copies=True) if order else out


def top_outliers(outliers: DataFrame, k: int = DEFAULT.top_k) -> DataFrame:
    """The k heaviest deviations (a top-k: each task keeps k rows, the driver merges k per task)."""
    return outliers.orderBy(*OUTLIER_ORDER).limit(k)


def country_incoming(profile: DataFrame, rating: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Total incoming (credit) amount from the high-risk list per customer, with segment.

    Read from the profile, which sums those credits, so no fact row is read again. The segment
    depends on the customer only: grouping by (customer, segment) after the join gives the
    same rows. The NULL customer is listed, but has no rating.
    """
    credits = profile.where((F.col(SIGN) == cfg.credit) & (F.col("n_hrc") > 0))
    incoming = credits.select(F.col(ID), F.col("s_hrc").alias("TransactionAmount"))
    return incoming.join(rating.select(ID, "Risk_Segment"), ID, "left").select(ID, "TransactionAmount", "Risk_Segment")


def segment_thresholds(incoming: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Per segment: customers, mean, population stdev and percentiles of the monthly
    incoming amount, as inputs for choosing a rule threshold per segment.

    Percentiles are exact nearest-rank values at any size: value histograms by digits of
    the amount, aggregated map-side, so no segment is gathered or sorted in one task.
    """
    probs = list(cfg.segment_percentiles)
    moments = incoming.groupBy("Risk_Segment").agg(
        F.count(F.lit(1)).alias("num_customers"),
        F.avg("TransactionAmount").alias("mean_amount"),
        F.stddev_pop("TransactionAmount").alias("stddev_amount"),
    )
    pct = nearest_rank_percentiles(incoming, ["Risk_Segment"], "TransactionAmount", probs).withColumnRenamed("Risk_Segment", "_seg")
    out = moments.join(pct, F.col("Risk_Segment").eqNullSafe(F.col("_seg")), "left")
    return out.select(
        "Risk_Segment", "num_customers", "mean_amount", "stddev_amount", *[F.col(percentile_name(p)) for p in probs]
    )


def segment_limits(incoming: DataFrame, cfg: RiskConfig = DEFAULT, hits: int | None = None, share: float | None = None) -> DataFrame:
    """Per segment: the lowest amount limit that at most ``hits`` customers, or the given ``share``
    of its customers, lie above, and the widest gap between neighbouring amounts up to it.

    The limit is an amount that occurs (the one just below the allowed customers), so no
    lower one keeps the budget; 0 where every customer is allowed. ``gap_from`` to ``gap_to`` is a
    natural break: any limit from ``gap_from`` to below ``gap_to`` selects ``gap_hits`` customers
    (the highest of equally wide gaps; NULL where a segment has one amount only up to there).
    Searched in a cumulative histogram by digits of the amount, so no segment is sorted in a task.
    """
    hits = cfg.limit_hits if hits is None else hits
    share = cfg.limit_share if share is None else share
    allowed = str(int(hits)) if hits is not None else f"(n * {int(round(share * 10000))}) div 10000"
    seg, amount = "Risk_Segment", "TransactionAmount"
    lowest = F.expr(f"CASE WHEN n <= {allowed} THEN 0L ELSE limit END").alias("limit_amount")
    rank = kth_values(incoming, [seg], amount, {"limit": f"greatest(n - {allowed}, 1)"})
    rank = rank.select(F.col(seg).alias("_seg"), F.col("n").alias("num_customers"), lowest)
    same = F.col(seg).eqNullSafe(F.col("_seg"))
    gaps = consecutive_values(incoming, [seg], amount).join(rank, same).where(F.col("high") <= F.col("limit_amount"))
    widest = gaps.groupBy(F.col(seg).alias("_gseg")).agg(F.max(F.struct((F.col("high") - F.col("low")).alias("w"), "low", "high")).alias("g"))
    limits = rank.join(widest, F.col("_seg").eqNullSafe(F.col("_gseg")), "left").drop("_gseg")
    above = F.count(F.when(F.col(amount) > F.col("limit_amount"), 1)).alias("num_hits")
    beyond = F.count(F.when(F.col(amount) > F.col("g.low"), 1))
    out = incoming.join(limits, same).groupBy(seg, "num_customers", "limit_amount", "g").agg(above, beyond.alias("_gap_hits"))
    return out.select(
        seg, "num_customers", "limit_amount", "num_hits", F.col("g.low").alias("gap_from"), F.col("g.high").alias("gap_to"),
        F.when(F.col("g").isNotNull(), F.col("_gap_hits")).alias("gap_hits"),
    )


def segment_bounds(profile: DataFrame, rating: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Per (segment, sign): customers' clean moments merged upwards, and the exact whole amount
    that passes mean + k sigma of the whole segment (one row a segment and sign)."""
    groups = profile.where((F.col("n_rows") > 0) & F.col(ID).isNotNull() & F.col(SIGN).isNotNull())
    groups = groups.select(ID, SIGN, "n_rows", "s_amt", "q_amt").join(rating.select(ID, "Risk_Segment"), ID)
    merged = groups.where(F.col("Risk_Segment").isNotNull()).groupBy("Risk_Segment", SIGN).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("s_amt").alias("s_amt"), F.sum("q_amt").cast("decimal(38,0)").alias("q_amt")
    )
    n = F.col("n_rows")
    cfg = replace(cfg, sigma_multiplier=cfg.segment_sigma)
    merged = merged.withColumns(centred(n, F.col("s_amt"), F.col("q_amt")))
    merged = merged.withColumn("segment_threshold", threshold_columns(n, cfg)["threshold_single_transaction"])
    return merged.select("Risk_Segment", SIGN, "segment_threshold", alert_bounds(n, F.col("segment_threshold"), cfg)["outlier_from"].alias("segment_from"))


def segment_outliers(tx: DataFrame, profile: DataFrame, rating: DataFrame, cfg: RiskConfig = DEFAULT, hot: DataFrame | None = None, order: bool = True) -> DataFrame:
    """Clean rows strictly above mean + k sigma of their customer's segment (by sign): the second
    reading of Part II, against the segment's instead of the customer's own behaviour.

    The bounds (at most two rows a segment) are broadcast to the profile. Only customers whose
    largest amount passes their segment's bound go on to meet the facts.
    """
    few = F.broadcast(segment_bounds(profile, rating, cfg))
    groups = profile.where(F.col(ID).isNotNull() & F.col(SIGN).isNotNull()).select(ID, SIGN, "max_amt")
    groups = groups.join(rating.select(ID, "Risk_Segment", "TOTAL_Score"), ID).join(few, ["Risk_Segment", SIGN])
    groups = groups.where(F.col("max_amt") >= F.col("segment_from")).drop("max_amt")
    facts = tx.where((F.col(AMT) > 0) & F.col(ID).isNotNull() & F.col(SIGN).isNotNull()).select(ID, SIGN, AMT, CTRY)
    out = with_bounds(facts, groups, hot).where(F.col(AMT) >= F.col("segment_from"))
    deviation = (F.col("segment_threshold") - F.col(AMT)).alias("deviation_amount")
    out = out.select(ID, SIGN, AMT, CTRY, "Risk_Segment", "TOTAL_Score", "segment_threshold", deviation)
    return total_order(out, *OUTLIER_ORDER, copies=True) if order else out


def rule_hits(incoming: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Customers whose incoming amount is above their segment's threshold."""
    cond = None
    for seg, limit in cfg.rule_thresholds:
        c = (F.col("Risk_Segment") == seg) & (F.col("TransactionAmount") > limit)
        cond = c if cond is None else (cond | c)
    return incoming.where(cond)
