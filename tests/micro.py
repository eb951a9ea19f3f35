"""Boundary micro-fixture: 19 customers plus a NULL one (FIXTURES.md §2)."""

MICRO_ROWS = (
    [(1, "Credit", 100, "FI")] * 500
    + [(2, "Credit", 100, "FI")] * 501
    + [(3, "Credit", 100, "FI")] * 499
    + [(4, "Credit", 500, "DK")] * 20
    + [(5, "Credit", 501, "DK")] * 20
    + [(6, "Credit", 20000, "SE")]
    + [(7, "Debit", 20000, "SE")]
    + [(8, "Credit", 10, "RU"), (8, "Debit", 40, "FI"), (8, "Credit", 12, "FI"), (8, "Debit", 44, "FI")]
    + [(9, "Credit", 10, "RO")] * 3
    + [(9, "Credit", 30, "FI")] * 2
    + [(9, "Debit", 20, "DK")] * 2
    + [(9, "Debit", 30, "DK")] * 2
    + [(9, "Debit", 25, "SE")]
    + [(10, "Credit", 90, "RO")]
    + [(10, "Credit", a, "FI") for a in range(100, 149)]
    + [(10, "Debit", a, "FI") for a in range(200, 250)]
    + [(11, "Credit", 48, "FI"), (11, "Credit", 50, "FI"), (11, "Debit", 45, "FI"), (11, "Debit", 55, "FI")]
    + [(12, "Credit", 51, "FI"), (12, "Credit", 51, "FI"), (12, "Debit", 45, "FI"), (12, "Debit", 55, "FI")]
    + [(13, "Credit", 10, "FI")] * 4
    + [(13, "Credit", 60, "FI"), (13, "Debit", 10, "FI"), (13, "Debit", 20, "FI"), (13, "Debit", 30, "FI")]
    + [(14, "Credit", -338, "FI"), (14, "Debit", 0, "SE")]
    + [(15, "Credit", 70, "FI"), (15, "Credit", 90, "FI")]
    + [(15, "Debit", -37, "FI"), (15, "Debit", 30, "FI"), (15, "Debit", 31, "FI")]
    + [(16, "Credit", 10, "NO"), (16, "Credit", 20, "NO"), (16, "Debit", 15, "NO"), (16, "Debit", 25, "NO")]
    + [(17, "Credit", 10, None), (17, "Credit", 20, "FI"), (17, "Debit", 15, "FI"), (17, "Debit", 25, "FI")]
    + [(18, None, 10, "FI"), (18, None, 20, "FI")]
    + [(None, "Credit", 10, "FI"), (None, "Debit", 20, "FI")]
    + [(19, "Credit", 3, "FI"), (19, "Credit", 300, "FI"), (19, "Credit", 4, "DK")]
    + [(19, "Debit", a, "SE") for a in range(100, 110)]
)

# ID -> (n, sum, ScoreFrequency, RO ratio, CDRatio, total rows, unusual, points, total, segment)
EXPECTED = {
    1: (500, 50000, None, 0.0, 10.0, 500, 500, (0, 0, 0, 0, 0, 0, 0, 1, 3), 4, "Medium-High"),
    2: (501, 50100, 6, 0.0, 10.0, 501, 501, (3, 0, 0, 0, 0, 0, 0, 1, 3), 7, "High"),
    3: (499, 49900, 5, 0.0, 10.0, 499, 499, (2, 0, 0, 0, 0, 0, 0, 1, 3), 6, "High"),
    4: (20, 10000, None, 0.0, 10.0, 20, 20, (0, 0, 0, 0, 0, 0, 0, 1, 3), 4, "Medium-High"),
    5: (20, 10020, 4, 0.0, 10.0, 20, 20, (1, 0, 0, 0, 0, 0, 0, 1, 3), 5, "Medium-High"),
    6: (1, 20000, 1, 0.0, 10.0, 1, 1, (0, 0, 0, 0, 0, 0, 0, 1, 1), 2, "Medium-Low"),
    7: (1, 20000, 1, 0.0, 0.0, 1, 1, (0, 0, 0, 0, 1, 0, 1, 0, 1), 3, "Medium-High"),
    8: (4, 106, None, 0.0, 0.2619, 4, 0, (0, 1, 0, 3, 1, 0, 0, 0, 0), 5, "Medium-High"),
    9: (10, 215, None, 0.3, 0.72, 10, 0, (0, 1, 3, 0, 0, 0, 0, 0, 0), 4, "Medium-High"),
    10: (100, 17391, 5, 0.01, 0.5493, 100, 0, (2, 1, 0, 0, 0, 0, 0, 0, 0), 3, "Medium-High"),
    11: (4, 198, None, 0.0, 0.98, 4, 0, (0, 0, 0, 0, 0, 1, 0, 0, 0), 1, "Medium-Low"),
    12: (4, 202, None, 0.0, 1.02, 4, 2, (0, 0, 0, 0, 0, 1, 0, 0, 1), 2, "Medium-Low"),
    13: (8, 160, None, 0.0, 1.6667, 8, 1, (0, 0, 0, 0, 0, 0, 0, 0, 1), 1, "Medium-Low"),
    15: (4, 221, None, 0.0, 2.6230, 5, 0, (0, 0, 0, 0, 0, 0, 0, 0, 0), 0, "Low"),
    16: (4, 70, None, None, 0.75, 4, 0, (0, 0, 0, 0, 0, 0, 0, 0, 0), 0, "Low"),
    17: (3, 70, None, 0.0, 0.75, 4, 0, (0, 0, 0, 0, 0, 0, 0, 0, 0), 0, "Low"),
    18: (2, 30, None, 0.0, 10.0, 2, 0, (0, 0, 0, 0, 0, 0, 0, 0, 0), 0, "Low"),
    19: (13, 1352, None, 0.0, 0.2938, 13, 0, (0, 0, 0, 0, 1, 0, 1, 0, 0), 2, "Medium-Low"),
    None: (None, None, None, None, None, None, None, (0, None, 0, 0, 0, 0, 0, 0, None), None, None),
}


def micro_df(spark):
    from txrisk.sources.schema import TRANSACTION_SCHEMA

    return spark.createDataFrame(MICRO_ROWS, TRANSACTION_SCHEMA)


def micro_values_sql() -> str:
    return values_sql(MICRO_ROWS)


def values_sql(rows) -> str:
    """DuckDB SELECT over literal transaction rows, typed like the declared schema."""

    def lit(v):
        if v is None:
            return "NULL"
        return f"'{v}'" if isinstance(v, str) else str(v)

    body = ",\n".join(f"({', '.join(lit(v) for v in r)})" for r in rows)
    return (
        "SELECT CAST(CustomerID AS INTEGER) AS CustomerID, CAST(TransactionSign AS VARCHAR) AS TransactionSign,"
        " CAST(TransactionAmount AS INTEGER) AS TransactionAmount, CAST(TransactionCountry AS VARCHAR) AS TransactionCountry"
        f" FROM (VALUES {body}) v(CustomerID, TransactionSign, TransactionAmount, TransactionCountry)"
    )
