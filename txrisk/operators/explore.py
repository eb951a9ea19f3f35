"""Exploration queries on the raw transaction table (E1-E11)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.config import DEFAULT, RiskConfig
from txrisk.functions.ordering import total_order
from txrisk.functions.scoring import band
from txrisk.operators.quality import country_distribution
from txrisk.session import materialize
from txrisk.sources.schema import AMT, COLUMNS, CTRY, ID, SIGN


def high_risk_countries(tx: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """The high-risk country list, restricted to countries present in the data (E1)."""
    return (
        tx.where(F.col(CTRY).isin(list(cfg.high_risk_countries)))
        .select(F.col(CTRY).alias("CountryName"))
        .distinct()
    )


def country_distribution_raw(tx: DataFrame, order: bool = True) -> DataFrame:
    """Rows per country on the raw table, most first (E2)."""
    return country_distribution(tx, order=order)


def country_rows(tx: DataFrame, countries: Sequence[str]) -> DataFrame:
    """Rows in any of ``countries`` (E3 with the outlier list, E4 with one country)."""
    return tx.where(F.col(CTRY).isin(list(countries))).select(*COLUMNS)


#: 64-bit words of an id bitmap that are broadcast at most (about 40 bytes each, so 80 MB; up to
#: 134 million ids where ids are dense).
MAX_WORDS = 1 << 21


def id_bitmap(ids: DataFrame) -> DataFrame:
    """Exact set of customer ids as a bitmap: one row a word of 64 ids that has any of them."""
    word = F.shiftright(F.col(ID).cast("long"), 6).alias("_word")
    bit = F.expr(f"shiftleft(1L, cast({ID} & 63 as int))")
    return ids.where(F.col(ID).isNotNull()).groupBy(word).agg(F.bit_or(bit).alias("_bits"))


def rows_of(tx: DataFrame, ids: DataFrame) -> DataFrame:
    """Every row of the customers in ``ids`` (repeats and NULLs allowed).

    The ids become a kept bitmap, whose size is known before it is used: up to ``MAX_WORDS`` words
    are broadcast and the facts are filtered where they are scanned, so no fact row of another
    customer moves and a hot customer's rows stay in their tasks. A larger set is a left semi
    join, whose hot keys AQE splits.
    """
    facts = tx.select(*COLUMNS)
    words = materialize(id_bitmap(ids))
    if words.count() > MAX_WORDS:
        return facts.join(ids.select(ID).distinct(), ID, "left_semi")
    inside = F.expr(f"getbit(_bits, cast({ID} & 63 as int)) = 1")
    held = facts.join(F.broadcast(words), F.shiftright(F.col(ID).cast("long"), 6) == F.col("_word"))
    return held.where(inside).select(*COLUMNS)


def customers_with_country(tx: DataFrame, countries: Sequence[str], order: bool = True, cube: DataFrame | None = None) -> DataFrame:
    """Every row of the customers with at least one row in ``countries`` (E5, E6): ``IN
    (sub-query)`` as a bitmap of the ids, read from the ``cube`` where there is one. Only the
    result rows are exchanged for the report order."""
    ids = (tx if cube is None else cube).where(F.col(CTRY).isin(list(countries))).select(ID)
    out = rows_of(tx, ids)
    return total_order(out, ID, copies=True) if order else out


def customer_sign_profile(tx: DataFrame) -> DataFrame:
    """Per (customer, sign): total, count and integer (truncated) mean amount (E7)."""
    total = F.sum(AMT)
    count = F.count(F.col(AMT))
    avg_int = F.expr(f"sum({AMT}) div nullif(count({AMT}), 0)").cast("int")
    return tx.groupBy(ID, SIGN).agg(
        total.alias("tot_amount"),
        count.alias("tot_transactions"),
        avg_int.alias("avg_transaction_amount"),
    )


def customer_country_profile(tx: DataFrame, order: bool = True) -> DataFrame:
    """Per (customer, country): count of rows and total amount (E8)."""
    out = tx.groupBy(ID, CTRY).agg(
        F.count(F.col(CTRY)).alias("num_transactions"),
        F.sum(AMT).alias("sum_transactions"),
    )
    return total_order(out, ID) if order else out


def round_amounts(
    tx: DataFrame, unit: int = DEFAULT.round_unit, over: int | None = None, order: bool = True
) -> DataFrame:
    """Customers with amounts that are a multiple of ``unit`` (E9), optionally only above
    ``over`` (E10). ``%`` keeps the dividend's sign, so 0 and -100 count as round."""
    cond = F.col(AMT) % unit == 0
    if over is not None:
        cond = cond & (F.col(AMT) > over)
    out = tx.where(cond).groupBy(ID).agg(F.count(F.col(ID)).alias("frequency_transactions"))
    return total_order(out, "frequency_transactions", desc=["frequency_transactions"]) if order else out


def frequency_histogram(tx: DataFrame, cfg: RiskConfig = DEFAULT, order: bool = True) -> DataFrame:
    """Customers per frequency cluster (E11): count per customer, band, count per band."""
    per_customer = tx.groupBy(ID).agg(F.count(F.col(CTRY)).alias("num_transactions"))
    clustered = per_customer.select(band(F.col("num_transactions"), cfg.histogram_bands).alias("FrequencyCluster"))
    out = clustered.groupBy("FrequencyCluster").agg(F.count(F.col("FrequencyCluster")).alias("num_customer"))
    return out.orderBy("FrequencyCluster") if order else out


def explore_all(tx: DataFrame, cfg: RiskConfig = DEFAULT, cube: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every exploration result, lazily, keyed by name; those that list rows read the ids of
    the ``cube`` where there is one."""
    return {
        "high_risk_countries": high_risk_countries(tx, cfg),
        "country_distribution_raw": country_distribution_raw(tx),
        "outlier_country_transactions": country_rows(tx, cfg.outlier_countries),
        "country_transactions": country_rows(tx, [cfg.high_risk_country]),
        "customers_with_country": customers_with_country(tx, [cfg.high_risk_country], cube=cube),
        "customers_with_outliers": customers_with_country(tx, cfg.outlier_countries, cube=cube),
        "customer_sign_profile": customer_sign_profile(tx),
        "customer_country_profile": customer_country_profile(tx),
        "round_amounts": round_amounts(tx, cfg.round_unit),
        "round_amounts_over": round_amounts(tx, cfg.round_unit, cfg.round_over),
        "frequency_histogram": frequency_histogram(tx, cfg),
    }
