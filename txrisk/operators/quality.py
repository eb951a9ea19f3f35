"""Data-quality checks on the raw transaction table (Q1-Q13).

Each check is a DataFrame -> DataFrame function; ``order=True`` reproduces the report
order of the published checks, with tie-breakers so the order is total.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.config import DEFAULT, RiskConfig
from txrisk.functions.ordering import total_order
from txrisk.functions.stats import exact_median, exact_moments, value_counts
from txrisk.session import materialize
from txrisk.sources.schema import AMT, COLUMNS, CTRY, ID, SIGN


def preview(tx: DataFrame, n: int = 1) -> DataFrame:
    """Any ``n`` rows (a look at the load; which rows is unspecified)."""
    return tx.limit(n)


def import_completeness(tx: DataFrame) -> DataFrame:
    """Rows loaded and total absolute amount (Q1)."""
    return tx.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.sum(F.abs(F.col(AMT))).alias("total_abs_amount"),
    )


def records_per_customer(tx: DataFrame, order: bool = True) -> DataFrame:
    """Rows per customer, most first (Q2). ``COUNT(CustomerID)`` is 0 for the NULL customer."""
    out = tx.groupBy(ID).agg(F.count(F.col(ID)).alias("customer_records"))
    return total_order(out, "customer_records", desc=["customer_records"]) if order else out


def invalid_customer_ids(tx: DataFrame) -> DataFrame:
    """Distinct customer ids below 1 (Q3)."""
    return tx.where(F.col(ID) < 1).select(ID).distinct()


def customer_history(tx: DataFrame, customer_id: int = DEFAULT.investigated_customer, order: bool = True) -> DataFrame:
    """All rows of one customer, largest amount first (Q4). The filter reaches the scan."""
    out = tx.where(F.col(ID) == customer_id).select(*COLUMNS)
    return total_order(out, AMT, desc=[AMT], copies=True) if order else out


def amount_range_by_sign(tx: DataFrame) -> DataFrame:
    """Smallest and largest amount per sign (Q5)."""
    return tx.groupBy(SIGN).agg(
        F.min(AMT).alias("min_transaction_amount"),
        F.max(AMT).alias("max_transaction_amount"),
    )


def nonpositive_profile(tx: DataFrame) -> DataFrame:
    """Range, absolute total and count of rows with amount <= 0, per sign (Q6)."""
    return (
        tx.where(F.col(AMT) <= 0)
        .groupBy(SIGN)
        .agg(
            F.min(AMT).alias("min_transaction_amount"),
            F.max(AMT).alias("max_transaction_amount"),
            F.sum(F.abs(F.col(AMT))).alias("total_abs_amount"),
            F.count(F.col(SIGN)).alias("num_transactions"),
        )
    )


def concentration_by_customer_country(tx: DataFrame, order: bool = True) -> DataFrame:
    """(customer, country) pairs with more than one negative row (Q7)."""
    out = (
        tx.where(F.col(AMT) < 0)
        .groupBy(ID, CTRY)
        .agg(F.count(F.col(ID)).alias("num_records"))
        .where(F.col("num_records") > 1)
    )
    return total_order(out, "num_records", desc=["num_records"]) if order else out


def concentration_by_amount(tx: DataFrame, order: bool = True) -> DataFrame:
    """Negative amounts occurring more than once (Q8)."""
    out = (
        tx.where(F.col(AMT) < 0)
        .groupBy(AMT)
        .agg(F.count(F.col(AMT)).alias("num_records"))
        .where(F.col("num_records") > 1)
    )
    return total_order(out, "num_records", desc=["num_records"]) if order else out


def amount_lookup(tx: DataFrame, amounts: Sequence[int] = DEFAULT.lookup_amounts) -> DataFrame:
    """Rows with one of the given amounts (Q9); the IN list is pushed to the scan."""
    return tx.where(F.col(AMT).isin(list(amounts))).select(*COLUMNS)


def zero_amounts(tx: DataFrame) -> DataFrame:
    """Rows with amount 0, per sign (Q10)."""
    return tx.where(F.col(AMT) == 0).groupBy(SIGN).agg(F.count(F.col(SIGN)).alias("num_transactions"))


def missing_values(tx: DataFrame) -> DataFrame:
    """Rows with a NULL in any column (Q11)."""
    cond = F.col(ID).isNull() | F.col(SIGN).isNull() | F.col(AMT).isNull() | F.col(CTRY).isNull()
    return tx.where(cond).select(*COLUMNS)


def country_distribution(tx: DataFrame, order: bool = False) -> DataFrame:
    """Rows per country; ``COUNT(TransactionCountry)`` is 0 for NULL (Q12 on clean, E2 on raw)."""
    out = tx.groupBy(CTRY).agg(F.count(F.col(CTRY)).alias("num_transactions"))
    return total_order(out, "num_transactions", desc=["num_transactions"]) if order else out


def amount_skew(tx: DataFrame) -> DataFrame:
    """Mean, exact median and population skewness of the signed amounts (Q13).

    All three are read from one histogram of the amounts, kept so that the facts are scanned
    once: exact power sums give mean and skewness, radix select the median, and no task holds
    the column. Skewness is (n^2 s3 - 3 n s1 s2 + 2 s1^3) / (n s2 - s1^2)^1.5, with the sums
    taken around the whole part of the mean, so nothing cancels.
    """
    hist = materialize(value_counts(tx, [], AMT))
    sums = exact_moments(hist).first()  # four numbers
    n = int(sums["n"] or 0)
    around = int(sums["s1"]) // n if n else 0
    centred = exact_moments(hist.withColumn("_v", F.col("_v") - F.lit(around).cast("long")))
    size = F.col("n").cast("double")
    m1, m2, m3 = (F.col(s).cast("double") / size for s in ("s1", "s2", "s3"))
    spread = m2 - m1 * m1
    moments = centred.select(
        (F.lit(around).cast("double") + m1).alias("avg_amount"),
        F.try_divide(m3 - 3 * m1 * m2 + 2 * m1 * m1 * m1, F.pow(spread, F.lit(1.5))).alias("skewness_amount"),
    )
    null = F.lit(None).cast("double")
    median = exact_median(tx.select(AMT), [], AMT, "median_amount", hist)
    both = moments.select("avg_amount", null.alias("median_amount"), "skewness_amount").unionByName(
        median.select(null.alias("avg_amount"), "median_amount", null.alias("skewness_amount"))
    )
    return both.agg(*[F.max(c).alias(c) for c in ("avg_amount", "median_amount", "skewness_amount")])


def check_all(tx: DataFrame, clean: DataFrame, cfg: RiskConfig = DEFAULT) -> dict[str, DataFrame]:
    """Every check, lazily, keyed by name."""
    return {
        "import_completeness": import_completeness(tx),
        "records_per_customer": records_per_customer(tx),
        "invalid_customer_ids": invalid_customer_ids(tx),
        "customer_history": customer_history(tx, cfg.investigated_customer),
        "amount_range_by_sign": amount_range_by_sign(tx),
        "nonpositive_profile": nonpositive_profile(tx),
        "concentration_by_customer_country": concentration_by_customer_country(tx),
        "concentration_by_amount": concentration_by_amount(tx),
        "amount_lookup": amount_lookup(tx, cfg.lookup_amounts),
        "zero_amounts": zero_amounts(tx),
        "missing_values": missing_values(tx),
        "country_distribution_clean": country_distribution(clean),
        "amount_skew": amount_skew(tx),
    }
