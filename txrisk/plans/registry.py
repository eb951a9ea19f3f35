"""Named queries over the derived transaction fixtures: name -> (spark, sf_dir) -> DataFrame.

Every query reads the whole fixture table derived from the driver's parquet; none
filters to an id subset. Doubles are rounded to 6 places, as in the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txrisk.config import DEFAULT, RiskConfig
from txrisk.operators import explore as ex
from txrisk.operators import features as feat
from txrisk.operators import quality as q
from txrisk.operators.cube import profile_of, transaction_cube
from txrisk.plans.periods import PeriodStore
from txrisk.plans.riskrun import RiskRun, country_rule_run, rate_customer
from txrisk.session import Workspace, materialize
from txrisk.sources.fixtures import FIXTURES, dirty_lines
from txrisk.sources.ingest import STATUS, checked_lines, clean
from txrisk.sources.schema import COLUMNS
from txrisk.sources.sinks import hand_off

# The list of the table-driven run: one country is in no other list ("NO").
LISTED_COUNTRIES = ("RO", "PL", "NO")
ROLLING_MONTHS = 3

Query = Callable[[SparkSession, str], DataFrame]

# Customer looked up by the single-customer rating (present at every scale factor).
LOOKUP_CUSTOMER = 7
# Amounts of the fixture's dirt rule (-37 to -96); the published ones hardly occur in it.
LOOKUP_AMOUNTS = (-41, -37)
# The fixtures' amounts are spread almost evenly, so none passes mean + 2 sigma of a segment.
SEGMENT_CONFIG = RiskConfig(segment_sigma=1)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = [
        F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def _on(fixture: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_doubles(build(FIXTURES[fixture](spark, sf_dir)))

    run.__name__ = f"{fixture}_query"
    return run


Builder = tuple[str, Callable[[DataFrame], DataFrame]]


def _raw(fn: Callable[[DataFrame], DataFrame], fixture: str = "tx_lines") -> Builder:
    return fixture, fn


def _clean(fn: Callable[[DataFrame], DataFrame], fixture: str = "tx_lines") -> Builder:
    return fixture, lambda tx: fn(clean(tx))


def _run(attr: Callable[[RiskRun], DataFrame], fixture: str = "tx_lines") -> Builder:
    return fixture, lambda tx: attr(RiskRun(tx))


cfg = DEFAULT


def loaded_lines(lines: DataFrame) -> DataFrame:
    """Every line as the loader takes it: its columns if good, NULLs and the reason if not."""
    loaded = checked_lines(lines)
    status = F.coalesce(F.col(STATUS), F.lit("good"))
    return loaded.select(*[F.when(status == "good", F.col(c)).alias(c) for c in COLUMNS], status.alias(STATUS))


def handed_off(tx: DataFrame, fmt: str) -> DataFrame:
    """The rating as a written file reads back (rows and hash are compared on the way)."""
    rating = RiskRun(tx).rating
    return hand_off(rating, f"{Workspace(tx.sparkSession, 'hand-off').path}/rating", fmt)


def rated_by_list(tx: DataFrame, take: Callable[[RiskRun], DataFrame]) -> DataFrame:
    """A run whose high-risk list is a table (its countries joined to the cube)."""
    listed = tx.sparkSession.createDataFrame([(c,) for c in LISTED_COUNTRIES], "CountryName string")
    return take(RiskRun(tx, profile=materialize(profile_of(materialize(transaction_cube(tx)), DEFAULT, listed))))


def month_store(tx: DataFrame) -> PeriodStore:
    """Every month of the fixture, loaded into a store of its own."""
    store = PeriodStore(tx.sparkSession, f"{Workspace(tx.sparkSession, 'months').path}/cubes")
    store.load(tx)
    return store


# name -> (fixture, raw transactions -> result)
BUILDERS: dict[str, Builder] = {
    # sources
    "clean_transactions": _clean(lambda c: c),
    "loaded_lines": _raw(lambda tx: loaded_lines(dirty_lines(tx))),
    # data quality (Q1-Q13)
    "import_completeness": _raw(q.import_completeness),
    "records_per_customer": _raw(q.records_per_customer),
    "invalid_customer_ids": _raw(q.invalid_customer_ids),
    "customer_history": _raw(lambda tx: q.customer_history(tx, cfg.investigated_customer)),
    "amount_range_by_sign": _raw(q.amount_range_by_sign),
    "nonpositive_profile": _raw(q.nonpositive_profile),
    "concentration_by_customer_country": _raw(q.concentration_by_customer_country),
    "concentration_by_amount": _raw(q.concentration_by_amount),
    "amount_lookup": _raw(lambda tx: q.amount_lookup(tx, LOOKUP_AMOUNTS)),
    "zero_amounts": _raw(q.zero_amounts),
    "missing_values": _raw(q.missing_values),
    "country_distribution_clean": _clean(q.country_distribution),
    "amount_skew": _raw(q.amount_skew),
    # exploration (E1-E11)
    "high_risk_countries": _raw(ex.high_risk_countries),
    "country_distribution_raw": _raw(ex.country_distribution_raw),
    "outlier_country_transactions": _raw(lambda tx: ex.country_rows(tx, cfg.outlier_countries)),
    "country_transactions": _raw(lambda tx: ex.country_rows(tx, [cfg.high_risk_country])),
    "customers_with_country": _raw(lambda tx: ex.customers_with_country(tx, [cfg.high_risk_country])),
    "customers_with_outliers": _raw(lambda tx: ex.customers_with_country(tx, cfg.outlier_countries)),
    "customer_sign_profile": _raw(ex.customer_sign_profile),
    "customer_country_profile": _raw(ex.customer_country_profile),
    "round_amounts": _raw(lambda tx: ex.round_amounts(tx, cfg.round_unit)),
    "round_amounts_over": _raw(lambda tx: ex.round_amounts(tx, cfg.round_unit, cfg.round_over)),
    "frequency_histogram": _raw(ex.frequency_histogram),
    # risk features (R1-R7)
    "frequency_score": _clean(feat.frequency_score_table),
    "country_flags": _clean(feat.country_flags),
    "credit_debit_ratio": _clean(feat.credit_debit_ratio),
    "credit_debit_count_ratio": _clean(feat.credit_debit_count_ratio),
    "sign_thresholds": _clean(feat.sign_thresholds),
    "unusual_alerts": _run(lambda r: r.alerts),
    "transaction_alerts": _run(lambda r: r.transaction_alerts),
    "customer_base": _clean(feat.customer_base),
    # rating (R8-R12)
    "risk_features_wide": _run(lambda r: r.wide),
    "risk_points": _run(lambda r: r.points),
    "risk_rating": _run(lambda r: r.rating),
    "segment_summary": _run(lambda r: r.segment_summary),
    "customer_rating": _raw(lambda tx: rate_customer(tx, LOOKUP_CUSTOMER)),
    # outliers and the high-risk-country rule (R13-R17)
    "outlier_transactions": _run(lambda r: r.outliers()),
    "top_outlier_transactions": _run(lambda r: r.top_outliers()),
    "romania_incoming": _raw(lambda tx: country_rule_run(tx).incoming),
    "segment_thresholds": _raw(lambda tx: country_rule_run(tx).segment_thresholds),
    "segment_limits": _raw(lambda tx: country_rule_run(tx).segment_limits),
    "segment_outliers": _raw(lambda tx: RiskRun(tx, SEGMENT_CONFIG).segment_outliers()),
    "romania_rule_hits": _raw(lambda tx: country_rule_run(tx).rule_hits),
    # the high-risk list as a table, months, hand-off
    "risk_rating_by_list": _raw(lambda tx: rated_by_list(tx, lambda r: r.rating)),
    "incoming_by_list": _raw(lambda tx: rated_by_list(tx, lambda r: r.incoming)),
    "rolling_sign_thresholds": _raw(lambda tx: month_store(tx).rolling_thresholds(ROLLING_MONTHS), "tx_months"),
    "monthly_incoming": _raw(lambda tx: month_store(tx).monthly_incoming(), "tx_months"),
    "risk_rating_parquet": _raw(lambda tx: handed_off(tx, "parquet")),
    "risk_rating_csv": _raw(lambda tx: handed_off(tx, "csv")),
    # the rating on the second fixture, which reaches the outflow and one-to-many points
    "frequency_score_orders": _clean(feat.frequency_score_table, "tx_orders"),
    "frequency_histogram_orders": _raw(ex.frequency_histogram, "tx_orders"),
    "credit_debit_count_ratio_orders": _clean(feat.credit_debit_count_ratio, "tx_orders"),
    "risk_rating_orders": _run(lambda r: r.rating, "tx_orders"),
    "segment_outliers_orders": _raw(lambda tx: RiskRun(tx, SEGMENT_CONFIG).segment_outliers(), "tx_orders"),
    "segment_limits_orders": _raw(lambda tx: country_rule_run(tx).segment_limits, "tx_orders"),
    "outlier_transactions_orders": _run(lambda r: r.outliers(), "tx_orders"),
    "romania_incoming_orders": _raw(lambda tx: country_rule_run(tx).incoming, "tx_orders"),
}

QUERIES: dict[str, Query] = {name: _on(fx, fn) for name, (fx, fn) in BUILDERS.items()}

def run_on(name: str, tx: DataFrame) -> DataFrame:
    """Run a registered query on any raw transaction table (rounded like the registry)."""
    return round_doubles(BUILDERS[name][1](tx))
