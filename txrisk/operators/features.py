"""Risk features (drivers a-h) over the clean transactions.

Every feature is a roll-up of one mergeable profile: per (customer, sign) counts, sums
and sums of squares. Building the profile is one pass over the fact table;
partial aggregation runs before the shuffle, so a customer holding a third of all rows
still sends one row per map task. Each operator also accepts the transactions directly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.config import DEFAULT, RiskConfig
from txrisk.functions.scoring import (
    alert_bounds,
    centred,
    flag,
    frequency_score,
    ratio_or_sentinel,
    square_sum,
    threshold_columns,
)
from txrisk.sources.schema import AMT, CTRY, ID, SIGN

PROFILE_MARKER = "n_rows"


def customer_profile(tx: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """(CustomerID, TransactionSign) -> additive statistics, of raw or clean transactions.

    ``seen`` counts every row with a customer, as the alert totals read the raw table; all
    other columns count the clean rows (positive amount) alone. NULL customers and NULL
    signs stay as keys: the counting rules need them, only the joins drop them. ``q_amt``
    is exact (decimal), so thresholds do not depend on how rows were split over tasks.
    ``max_amt`` tells which groups can hold an alert at all; ``n_hrc`` and ``s_hrc`` count and
    sum the rows from the high-risk list (``n_hrc_unlisted``: countries no other column counts).
    """
    amt = F.col(AMT)
    positive = amt > 0
    listed = F.col(CTRY).isin(list(cfg.high_risk_countries))

    def clean_count(what) -> Column:
        return F.count(F.when(positive, what))

    return tx.groupBy(ID, SIGN).agg(
        F.count(F.col(ID)).alias("seen"),
        clean_count(F.lit(1)).alias(PROFILE_MARKER),
        clean_count(F.col(ID)).alias("n_id"),
        clean_count(F.col(CTRY)).alias("n_ctry"),
        F.sum(F.when(positive, amt)).alias("s_amt"),
        square_sum(amt, positive).alias("q_amt"),
        F.max(F.when(positive, amt)).alias("max_amt"),
        *[F.count(F.when(positive & (F.col(CTRY) == c), 1)).alias(f"n_{c}") for c in cfg.countries],
        F.count(F.when(positive & listed, 1)).alias("n_hrc"),
        F.count(F.when(positive & listed & ~F.col(CTRY).isin(list(cfg.countries)), 1)).alias("n_hrc_unlisted"),
        F.sum(F.when(positive & listed, amt)).alias("s_hrc"),
    )


def merge_profiles(first: DataFrame, *others: DataFrame) -> DataFrame:
    """The profile of several periods together: their statistics are additive, so a new
    month is added to a kept profile without another pass over the old months."""
    both = first
    for other in others:
        both = both.unionByName(other)
    parts = [(F.max if f.name == "max_amt" else F.sum)(f.name).cast(f.dataType).alias(f.name) for f in first.schema if f.name not in (ID, SIGN)]
    return both.groupBy(ID, SIGN).agg(*parts)


def as_profile(df: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Accept transactions (raw or clean) or an already built profile."""
    return df if PROFILE_MARKER in df.columns else customer_profile(df, cfg)


def _sum_when_sign(sign: str, col: str) -> Column:
    return F.sum(F.when(F.col(SIGN) == sign, F.col(col)))


def _customer_sums(profile: DataFrame, cfg: RiskConfig) -> DataFrame:
    """Roll the profile up to one row per customer with a clean row: the inputs of every feature."""
    return profile.where(F.col(PROFILE_MARKER) > 0).groupBy(ID).agg(
        F.sum("n_ctry").alias("num_ctry"),
        F.sum("s_amt").alias("amount"),
        *[F.sum(f"n_{c}").alias(f"cnt_{c}") for c in cfg.countries],
        F.sum("n_hrc").alias("cnt_hrc"),
        F.sum("n_hrc_unlisted").alias("cnt_hrc_unlisted"),
        _sum_when_sign(cfg.credit, "s_amt").alias("credit_amt"),
        _sum_when_sign(cfg.debit, "s_amt").alias("debit_amt"),
        _sum_when_sign(cfg.credit, "n_id").alias("credit_cnt"),
        _sum_when_sign(cfg.debit, "n_id").alias("debit_cnt"),
    )


def _frequency_cols(cfg: RiskConfig) -> dict[str, Column]:
    n = F.col("num_ctry")
    return {"num_transactions": n, "ScoreFrequency": frequency_score(n, F.col("amount"), cfg)}


def _country_cols(cfg: RiskConfig) -> dict[str, Column]:
    cnt = {c: F.coalesce(F.col(f"cnt_{c}"), F.lit(0).cast("long")) for c in cfg.countries}
    nordics = sum((cnt[c] for c in cfg.nordics), F.lit(0).cast("long"))
    # a high-risk country that no count column has is part of the total all the same
    total = sum((cnt[c] for c in cfg.countries), F.coalesce(F.col("cnt_hrc_unlisted"), F.lit(0).cast("long")))
    hrc = F.coalesce(F.col("cnt_hrc"), F.lit(0).cast("long"))
    return {
        **cnt,
        "nordics": nordics,
        "total_transactions": total,
        "NordicsOnly_check": flag(total - nordics == 0),
        "Russia_check": flag(cnt[cfg.sanctioned_country] != 0),
        "Romania_check": flag(hrc != 0),
        # 0/0 for a customer with only unlisted countries gives NULL, not an error
        "HRC_Trnsactions_Ratio": F.try_divide(hrc.cast("double"), total.cast("double")),
    }


def _amount_ratio_cols(cfg: RiskConfig) -> dict[str, Column]:
    credit = F.coalesce(F.col("credit_amt"), F.lit(0).cast("long"))
    debit = F.coalesce(F.col("debit_amt"), F.lit(0).cast("long"))
    ratio = ratio_or_sentinel(credit, debit, cfg.ratio_sentinel)
    return {
        "Credit": credit,
        "Debit": debit,
        "CDRatio": ratio,
        "CDRatio_Around_1_flag": flag(ratio.between(cfg.cd_ratio_low, cfg.cd_ratio_high)),
    }


def _count_ratio_cols(cfg: RiskConfig) -> dict[str, Column]:
    credit = F.coalesce(F.col("credit_cnt"), F.lit(0).cast("long"))
    debit = F.coalesce(F.col("debit_cnt"), F.lit(0).cast("long"))
    otm = ratio_or_sentinel(credit, debit, cfg.ratio_sentinel)
    mto = ratio_or_sentinel(debit, credit, cfg.ratio_sentinel)
    return {
        "Credit": credit,
        "Debit": debit,
        "OtMRatio": otm,
        "MtORatio": mto,
        "OtMRatio_flag": flag(otm <= cfg.count_ratio_flag),
        "MtORatio_flag": flag(mto <= cfg.count_ratio_flag),
    }


# Feature groups of the wide table: prefix -> column builder.
FEATURE_GROUPS = {
    "freq": _frequency_cols,
    "ctry": _country_cols,
    "cdr": _amount_ratio_cols,
    "cdt": _count_ratio_cols,
}


def _standalone(df: DataFrame, cols, cfg: RiskConfig) -> DataFrame:
    sums = _customer_sums(as_profile(df, cfg), cfg)
    return sums.select(F.col(ID), *[c.alias(name) for name, c in cols(cfg).items()])


def frequency_score_table(df: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """(a) CustomerID, num_transactions (non-null countries), ScoreFrequency 1-6 or NULL."""
    return _standalone(df, _frequency_cols, cfg)


def country_flags(df: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """(b, c) per-country counts, Nordic-only / Russia / Romania checks, high-risk share."""
    return _standalone(df, _country_cols, cfg)


def credit_debit_ratio(df: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """(d, e) credit and debit amount, their ratio (sentinel when no debit), near-1 flag."""
    return _standalone(df, _amount_ratio_cols, cfg)


def credit_debit_count_ratio(df: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """(g) credit and debit counts, one-to-many and many-to-one ratios and flags."""
    return _standalone(df, _count_ratio_cols, cfg)


def customer_features(df: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """All four feature groups in one roll-up, prefixed ``freq_``, ``ctry_``, ``cdr_``, ``cdt_``.

    One row per customer of the clean table, the NULL customer included. As in a join
    on ``=``, the NULL customer matches no feature row, so its features are NULL.
    """
    sums = _customer_sums(as_profile(df, cfg), cfg)
    has_key = F.col(ID).isNotNull()
    cols = [F.col(ID)]
    for prefix, builder in FEATURE_GROUPS.items():
        cols += [F.when(has_key, c).alias(f"{prefix}_{name}") for name, c in builder(cfg).items()]
    return sums.select(*cols)


def _keyed_groups(df: DataFrame, cfg: RiskConfig) -> DataFrame:
    """(customer, sign) groups with clean rows, both keys and their centred moments."""
    p = as_profile(df, cfg).where((F.col(PROFILE_MARKER) > 0) & F.col(ID).isNotNull() & F.col(SIGN).isNotNull())
    return p.withColumns(centred(F.col(PROFILE_MARKER), F.col("s_amt"), F.col("q_amt")))


def sign_thresholds(df: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """(h) per (customer, sign): mean, population stdev, threshold = mean + 2 sigma.

    Groups with a NULL customer or sign are left out (the mean and stdev tables are
    joined on ``=``). A one-row group has sigma 0, so its only row sits on the threshold.
    """
    n = F.col(PROFILE_MARKER)
    cols = threshold_columns(n, cfg)
    if cfg.min_group_size > 1:
        cols["threshold_single_transaction"] = F.when(n >= cfg.min_group_size, cols["threshold_single_transaction"])
    return _keyed_groups(df, cfg).select(ID, SIGN, *[c.alias(name) for name, c in cols.items()])


def sign_bounds(df: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Per (customer, sign): its rows, the threshold and the exact whole amounts that reach and pass it."""
    n = F.col(PROFILE_MARKER)
    threshold = "threshold_single_transaction"
    groups = _keyed_groups(df, cfg).where(n >= cfg.min_group_size)
    groups = groups.withColumn(threshold, threshold_columns(n, cfg)[threshold])
    bounds = alert_bounds(n, F.col(threshold), cfg)
    kept = [c for c in ("max_amt",) if c in groups.columns]
    return groups.select(ID, SIGN, PROFILE_MARKER, *kept, threshold, *[c.alias(name) for name, c in bounds.items()])


def reached_bounds(profile: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """The bounds of the groups whose largest amount reaches its bound. No other group has an
    alert, so only these have to meet the facts. Most groups are ruled out by a lower estimate
    of their threshold in doubles (its errors rounded down), before the exact whole-number test.
    """
    n, s, q = (F.col(c).cast("double") for c in (PROFILE_MARKER, "s_amt", "q_amt"))
    low = 1 - 1e-12
    spread = F.sqrt(F.greatest(q / n * low - (s / n) * (s / n), F.lit(0.0)))
    perhaps = F.col("max_amt").cast("double") + 1 >= s / n * low + F.lit(float(cfg.sigma_multiplier)) * spread * low
    return sign_bounds(profile.where((n > 0) & perhaps), cfg).where(F.col("max_amt") >= F.col("alert_from")).drop("max_amt")


def hot_groups(profile: DataFrame) -> DataFrame | None:
    """The (customer, sign) groups with more than half of a shuffle partition's even share of
    all rows, None if there is none. They are fewer than twice the shuffle partitions, so their
    bounds can be broadcast whatever the size of the data."""
    most = 2 * int(profile.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = profile.where(F.col(ID).isNotNull() & F.col(SIGN).isNotNull())
    total, largest = keyed.agg(F.sum("seen"), F.max("seen")).first()  # two numbers
    if not total or largest * most <= total:
        return None
    return keyed.where(F.col("seen") * most > total).select(ID, SIGN)


def with_bounds(facts: DataFrame, bounds: DataFrame, hot: DataFrame | None, how: str = "inner") -> DataFrame:
    """Fact rows with the bounds of their (customer, sign). Rows of hot groups meet theirs where
    they are scanned, the others in one exchange on the key; which is broadcast instead
    where the planner knows the bounds to be small."""
    if hot is None:
        return facts.join(bounds, [ID, SIGN], how)
    few = F.broadcast(hot)
    hot_facts = facts if how == "inner" else facts.join(few, [ID, SIGN], "left_semi")
    at_scan = hot_facts.join(F.broadcast(bounds.join(few, [ID, SIGN], "left_semi")), [ID, SIGN], how)
    return at_scan.unionByName(facts.join(few, [ID, SIGN], "left_anti").join(bounds, [ID, SIGN], how))


def alert_rows(tx: DataFrame, bounds: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Transactions that reach their own threshold; ``above`` marks those strictly above it.
    The only join of fact rows: alert counts, outliers and the top-k list are all read from
    its result.

    A threshold is positive, so rows with a non-positive amount or a NULL key never match and
    are not moved. ``bounds`` are those of :func:`reached_bounds`, ``hot`` of :func:`hot_groups`.
    """
    facts = tx.where((F.col(AMT) > 0) & F.col(ID).isNotNull() & F.col(SIGN).isNotNull()).select(ID, SIGN, AMT, CTRY)
    return (
        with_bounds(facts, bounds, hot)
        .where(F.col(AMT) >= F.col("alert_from"))
        .select(ID, SIGN, AMT, CTRY, "threshold_single_transaction", (F.col(AMT) >= F.col("outlier_from")).alias("above"))
    )


def unusual_alerts(profile: DataFrame, alerts: DataFrame) -> DataFrame:
    """Per customer of the raw table: rows, and rows at or above their own threshold.

    Totals come from the profile of the raw rows, so non-positive ones count, as published;
    ``alerts`` are the customer's :func:`alert_rows`.
    """
    seen = profile.groupBy(ID).agg(F.sum("seen").alias("total_num_transactions"))
    hits = alerts.groupBy(ID).agg(F.count(F.lit(1)).alias("_hits"))
    none = F.lit(0).cast("long")
    return seen.join(hits, ID, "left").select(
        ID, "total_num_transactions", F.coalesce("_hits", none).alias("num_unusual_transactions")
    )


def transaction_alerts(tx: DataFrame, profile: DataFrame, cfg: RiskConfig = DEFAULT, hot: DataFrame | None = None) -> DataFrame:
    """Every raw transaction with its customer's threshold, alert flag and deviation
    (threshold - amount). Rows without a threshold have flag 0 and a NULL deviation; those
    with a NULL key can have none and stay out of the join."""
    bounds = sign_bounds(profile, cfg).select(ID, SIGN, "threshold_single_transaction", "alert_from")
    keyed = F.col(ID).isNotNull() & F.col(SIGN).isNotNull()
    rows = tx.select(ID, SIGN, AMT, CTRY)
    known = with_bounds(rows.where(keyed), bounds, hot, "left")
    both = known.unionByName(rows.where(~keyed), allowMissingColumns=True)
    return both.select(
        ID, SIGN, AMT, CTRY, "threshold_single_transaction",
        flag(F.col(AMT) >= F.col("alert_from")).alias("transaction_unusual_alert"),
        (F.col("threshold_single_transaction") - F.col(AMT)).alias("deviation_amount"),
    )


def customer_base(df: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Distinct customers of the clean table, or of a profile's clean rows (NULL included)."""
    if PROFILE_MARKER in df.columns:
        df = df.where(F.col(PROFILE_MARKER) > 0)
    return df.select(ID).distinct()
