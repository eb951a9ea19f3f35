"""One additive summary of a transaction table and the results that are roll-ups of it.

The cube holds one row per (customer, sign, country) with statistics of the raw and of the
clean rows. All are sums, minima and maxima, so cubes of two periods or of two parts of a
table merge into the cube of both, and every check, exploration result, feature table and
country total below is a roll-up: the facts are read once for all of them. Partial aggregation
runs before the cube's shuffle; a hot customer sends one row a task and country.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.config import DEFAULT, RiskConfig
from txrisk.functions.ordering import total_order
from txrisk.functions.scoring import band, square_sum
from txrisk.sources.schema import AMT, CTRY, ID, SIGN

KEYS = (ID, SIGN, CTRY)
MINIMA = ("min_amt", "min_nonpos")
MAXIMA = ("max_amt", "max_nonpos", "max_pos")


def transaction_cube(tx: DataFrame, cfg: RiskConfig = DEFAULT, *more: str) -> DataFrame:
    """(customer, sign, country) -> additive statistics of raw transactions, NULL keys included;
    ``more`` names further key columns, such as the month."""
    amt = F.col(AMT)
    positive, nonpositive = amt > 0, amt <= 0
    whole = amt % cfg.round_unit == 0

    def times(cond: Column) -> Column:
        return F.count(F.when(cond, 1))

    return tx.groupBy(*more, *KEYS).agg(
        F.count(F.lit(1)).alias("n_raw"),
        F.count(amt).alias("n_amt"),
        F.sum(amt).alias("s_amt"),
        F.sum(F.abs(amt)).alias("s_abs"),
        F.min(amt).alias("min_amt"),
        F.max(amt).alias("max_amt"),
        times(amt < 0).alias("n_neg"),
        times(amt == 0).alias("n_zero"),
        times(nonpositive).alias("n_nonpos"),
        F.min(F.when(nonpositive, amt)).alias("min_nonpos"),
        F.max(F.when(nonpositive, amt)).alias("max_nonpos"),
        F.sum(F.when(nonpositive, F.abs(amt))).alias("s_nonpos"),
        times(whole).alias("n_round"),
        times(whole & (amt > cfg.round_over)).alias("n_round_over"),
        times(positive).alias("n_pos"),
        F.sum(F.when(positive, amt)).alias("s_pos"),
        square_sum(amt, positive).alias("q_pos"),
        F.max(F.when(positive, amt)).alias("max_pos"),
    )


def merge_cubes(first: DataFrame, *others: DataFrame) -> DataFrame:
    """The cube of several periods or parts together."""
    both = first
    for other in others:
        both = both.unionByName(other)

    def merged(name: str) -> Column:
        return F.min(name) if name in MINIMA else F.max(name) if name in MAXIMA else F.sum(name)

    return both.groupBy(*KEYS).agg(*[merged(f.name).cast(f.dataType).alias(f.name) for f in first.schema if f.name not in KEYS])


def profile_of(cube: DataFrame, cfg: RiskConfig = DEFAULT, high_risk: DataFrame | None = None) -> DataFrame:
    """The (customer, sign) profile of :func:`txrisk.operators.features.customer_profile`.

    ``high_risk`` (column ``CountryName``) replaces the configured list: it is joined to the
    cube by country, so any number of countries can be listed, and no fact row meets it.
    """
    ctry = F.col(CTRY)
    if high_risk is None:
        listed = ctry.isin(list(cfg.high_risk_countries))
    else:
        names = high_risk.select(F.col("CountryName").alias("_listed")).where("_listed is not null").distinct()
        cube = cube.join(names, ctry == F.col("_listed"), "left")
        listed = F.col("_listed").isNotNull()
    zero = F.lit(0).cast("long")
    n_pos = F.col("n_pos")

    def when(cond: Column, name: str) -> Column:
        return F.sum(F.when(cond, F.col(name)).otherwise(zero))

    return cube.groupBy(ID, SIGN).agg(
        when(F.col(ID).isNotNull(), "n_raw").alias("seen"),
        F.sum(n_pos).alias("n_rows"),
        when(F.col(ID).isNotNull(), "n_pos").alias("n_id"),
        when(ctry.isNotNull(), "n_pos").alias("n_ctry"),
        F.sum("s_pos").alias("s_amt"),
        F.sum("q_pos").cast("decimal(30,0)").alias("q_amt"),
        F.max("max_pos").alias("max_amt"),
        *[when(ctry == c, "n_pos").alias(f"n_{c}") for c in cfg.countries],
        when(listed, "n_pos").alias("n_hrc"),
        when(listed & ~F.coalesce(ctry.isin(list(cfg.countries)), F.lit(False)), "n_pos").alias("n_hrc_unlisted"),
        F.sum(F.when(listed, F.col("s_pos"))).alias("s_hrc"),
    )


# --- data quality ------------------------------------------------------------------------


def import_completeness(cube: DataFrame) -> DataFrame:
    return cube.agg(F.sum("n_raw").alias("total_records"), F.sum("s_abs").alias("total_abs_amount")).select(
        F.coalesce("total_records", F.lit(0).cast("long")).alias("total_records"), "total_abs_amount"
    )


def records_per_customer(cube: DataFrame, order: bool = True) -> DataFrame:
    per = cube.groupBy(ID).agg(F.sum(F.when(F.col(ID).isNotNull(), F.col("n_raw")).otherwise(F.lit(0).cast("long"))).alias("customer_records"))
    return total_order(per, "customer_records", desc=["customer_records"]) if order else per


def invalid_customer_ids(cube: DataFrame) -> DataFrame:
    return cube.where(F.col(ID) < 1).select(ID).distinct()


def amount_range_by_sign(cube: DataFrame) -> DataFrame:
    return cube.groupBy(SIGN).agg(F.min("min_amt").alias("min_transaction_amount"), F.max("max_amt").alias("max_transaction_amount"))


def nonpositive_profile(cube: DataFrame) -> DataFrame:
    return (
        cube.where("n_nonpos > 0")
        .groupBy(SIGN)
        .agg(
            F.min("min_nonpos").alias("min_transaction_amount"),
            F.max("max_nonpos").alias("max_transaction_amount"),
            F.sum("s_nonpos").alias("total_abs_amount"),
            F.sum(F.when(F.col(SIGN).isNotNull(), F.col("n_nonpos")).otherwise(F.lit(0).cast("long"))).alias("num_transactions"),
        )
    )


def concentration_by_customer_country(cube: DataFrame, order: bool = True) -> DataFrame:
    out = (
        cube.where(F.col("n_neg") > 0)
        .where(F.col(ID).isNotNull())  # COUNT(CustomerID) is 0 for the NULL customer
        .groupBy(ID, CTRY)
        .agg(F.sum("n_neg").alias("num_records"))
        .where(F.col("num_records") > 1)
    )
    return total_order(out, "num_records", desc=["num_records"]) if order else out


def zero_amounts(cube: DataFrame) -> DataFrame:
    counted = F.when(F.col(SIGN).isNotNull(), F.col("n_zero")).otherwise(F.lit(0).cast("long"))
    return cube.where("n_zero > 0").groupBy(SIGN).agg(F.sum(counted).alias("num_transactions"))


def country_distribution(cube: DataFrame, clean: bool = False, order: bool = False) -> DataFrame:
    name = "n_pos" if clean else "n_raw"
    counted = F.when(F.col(CTRY).isNotNull(), F.col(name)).otherwise(F.lit(0).cast("long"))
    out = cube.where(F.col(name) > 0).groupBy(CTRY).agg(F.sum(counted).alias("num_transactions"))
    return total_order(out, "num_transactions", desc=["num_transactions"]) if order else out


# --- exploration -------------------------------------------------------------------------


def high_risk_countries(cube: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    return cube.where(F.col(CTRY).isin(list(cfg.high_risk_countries))).select(F.col(CTRY).alias("CountryName")).distinct()


def customer_sign_profile(cube: DataFrame) -> DataFrame:
    sums = cube.groupBy(ID, SIGN).agg(F.sum("s_amt").alias("tot_amount"), F.sum("n_amt").alias("tot_transactions"))
    return sums.withColumn("avg_transaction_amount", F.expr("tot_amount div nullif(tot_transactions, 0)").cast("int"))


def customer_country_profile(cube: DataFrame, order: bool = True) -> DataFrame:
    counted = F.when(F.col(CTRY).isNotNull(), F.col("n_raw")).otherwise(F.lit(0).cast("long"))
    out = cube.groupBy(ID, CTRY).agg(F.sum(counted).alias("num_transactions"), F.sum("s_amt").alias("sum_transactions"))
    return total_order(out, ID) if order else out


def round_amounts(cube: DataFrame, over: bool = False, order: bool = True) -> DataFrame:
    """E9, or E10 with ``over``: unit and bound are those the cube was built with."""
    name = "n_round_over" if over else "n_round"
    counted = F.when(F.col(ID).isNotNull(), F.col(name)).otherwise(F.lit(0).cast("long"))
    out = cube.where(F.col(name) > 0).groupBy(ID).agg(F.sum(counted).alias("frequency_transactions"))
    return total_order(out, "frequency_transactions", desc=["frequency_transactions"]) if order else out


def frequency_histogram(cube: DataFrame, cfg: RiskConfig = DEFAULT, order: bool = True) -> DataFrame:
    counted = F.when(F.col(CTRY).isNotNull(), F.col("n_raw")).otherwise(F.lit(0).cast("long"))
    per = cube.groupBy(ID).agg(F.sum(counted).alias("n"))
    out = per.select(band(F.col("n"), cfg.histogram_bands).alias("FrequencyCluster")).groupBy("FrequencyCluster")
    out = out.agg(F.count(F.col("FrequencyCluster")).alias("num_customer"))
    return out.orderBy("FrequencyCluster") if order else out


def cube_results(cube: DataFrame, cfg: RiskConfig = DEFAULT) -> dict[str, DataFrame]:
    """Every check and exploration result that is a roll-up, by the name of its stand-alone form."""
    return {
        "import_completeness": import_completeness(cube),
        "records_per_customer": records_per_customer(cube),
        "invalid_customer_ids": invalid_customer_ids(cube),
        "amount_range_by_sign": amount_range_by_sign(cube),
        "nonpositive_profile": nonpositive_profile(cube),
        "concentration_by_customer_country": concentration_by_customer_country(cube),
        "zero_amounts": zero_amounts(cube),
        "country_distribution_clean": country_distribution(cube, clean=True),
        "high_risk_countries": high_risk_countries(cube, cfg),
        "country_distribution_raw": country_distribution(cube, order=True),
        "customer_sign_profile": customer_sign_profile(cube),
        "customer_country_profile": customer_country_profile(cube),
        "round_amounts": round_amounts(cube),
        "round_amounts_over": round_amounts(cube, over=True),
        "frequency_histogram": frequency_histogram(cube, cfg),
    }
