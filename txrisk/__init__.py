"""txrisk: transaction-monitoring data quality, exploration and customer risk rating on Spark.

Layout:
  sources/    schema, delimited loader with quarantine, clean view, fixtures, sinks
  functions/  column expressions (bands, points, thresholds), exact order statistics
  operators/  quality (Q1-Q13), explore (E1-E11), features / rating / rules (R1-R17)
  plans/      the end-to-end rating run, the query registry and its SQL oracle
  streaming/  incremental file ingest with the same parser and quarantine
"""

from txrisk.config import DEFAULT, RiskConfig
from txrisk.plans.riskrun import RiskRun, rate_customer, rate_customers
from txrisk.sources.ingest import clean, ingest_transactions, read_ingested, read_transactions

__all__ = [
    "DEFAULT",
    "RiskConfig",
    "RiskRun",
    "clean",
    "ingest_transactions",
    "rate_customer",
    "rate_customers",
    "read_ingested",
    "read_transactions",
]
