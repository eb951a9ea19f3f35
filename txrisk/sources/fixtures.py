"""Transaction tables derived from the driver's TPC-H-style parquet.

The original transaction file is not available, so two deterministic inputs with the
same four-column schema are derived from ``lineitem``/``orders``. Dirt (negative and
zero amounts, NULL and unlisted countries, customer 0) is put in on purpose by the
modulo rules below. The Spark and SQL forms are kept side by side; the SQL form is what
the DuckDB oracle reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.sources.schema import AMT, CTRY, ID, SIGN

TX_LINES_SQL = """
SELECT cast(o_custkey AS int) AS CustomerID,
       CASE WHEN l_returnflag = 'R' THEN 'Debit' ELSE 'Credit' END AS TransactionSign,
       cast(CASE WHEN k % 1500 = 7 THEN -(37 + l_partkey % 60)
                 WHEN k % 3000 = 11 THEN 0
                 ELSE floor(l_extendedprice / 10) END AS int) AS TransactionAmount,
       CASE WHEN k % 1000 < 4 THEN 'RO' WHEN k % 1000 = 4 THEN 'RU'
            WHEN k % 1000 = 5 THEN 'PL' WHEN k % 1000 = 6 THEN 'CY'
            WHEN k % 5000 = 13 THEN NULL WHEN k % 5000 = 17 THEN 'NO'
            WHEN l_partkey % 3 = 0 THEN 'FI' WHEN l_partkey % 3 = 1 THEN 'DK' ELSE 'SE' END AS TransactionCountry
FROM (SELECT *, l_orderkey * 7 + l_linenumber AS k FROM lineitem) l JOIN orders ON l_orderkey = o_orderkey
"""

TX_ORDERS_SQL = """
SELECT cast(o_custkey AS int) AS CustomerID,
       CASE WHEN o_orderkey % 5 < 2 THEN 'Debit' ELSE 'Credit' END AS TransactionSign,
       CASE WHEN o_orderkey % 1500 = 7 THEN -1 ELSE 1 END * cast(floor(o_totalprice / 50) AS int) AS TransactionAmount,
       CASE WHEN o_orderkey % 1000 < 10 THEN 'RO' WHEN o_orderkey % 1000 < 13 THEN 'RU'
            WHEN o_orderkey % 1000 < 16 THEN 'PL' WHEN o_orderkey % 1000 < 19 THEN 'CY'
            WHEN o_orderkey % 3 = 0 THEN 'FI' WHEN o_orderkey % 3 = 1 THEN 'DK' ELSE 'SE' END AS TransactionCountry
FROM orders
"""

TX_MONTHS_SQL = TX_LINES_SQL.replace("\nFROM (SELECT *, l_orderkey", ",\n       strftime(o_orderdate, '%Y-%m') AS period\nFROM (SELECT *, l_orderkey")

FIXTURE_SQL = {"tx_lines": TX_LINES_SQL, "tx_orders": TX_ORDERS_SQL, "tx_months": TX_MONTHS_SQL}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: The countries of ``_country``; NULL is the number after them.
COUNTRIES = ("RO", "RU", "PL", "CY", "NO", "FI", "DK", "SE")


def _country(k: Column, part: Column) -> Column:
    return (
        F.when(k % 1000 < 4, "RO")
        .when(k % 1000 == 4, "RU")
        .when(k % 1000 == 5, "PL")
        .when(k % 1000 == 6, "CY")
        .when(k % 5000 == 13, F.lit(None).cast("string"))
        .when(k % 5000 == 17, "NO")
        .when(part % 3 == 0, "FI")
        .when(part % 3 == 1, "DK")
        .otherwise("SE")
    )


def tx_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per line item; about 40 per customer. Main fixture."""
    return _tx_lines(spark, sf_dir)


def _tx_lines(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    k = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    part = F.col("l_partkey")
    amount = (
        F.when(k % 1500 == 7, -(37 + part % 60))
        .when(k % 3000 == 11, F.lit(0))
        .otherwise(F.floor(F.col("l_extendedprice") / 10))
    )
    # an item meets its order as amount and one byte for sign and country, so the join moves few bytes
    country = _country(k, part)
    number = F.lit(len(COUNTRIES))
    for i, c in enumerate(COUNTRIES):
        number = F.when(country == c, i).otherwise(number)
    debit = F.coalesce(F.col("l_returnflag") == "R", F.lit(False))
    code = (number * 2 + F.when(debit, 1).otherwise(0)).cast("byte")
    li = li.select("l_orderkey", amount.cast("int").alias(AMT), code.alias("_code"))
    number = F.shiftright(F.col("_code"), 1)
    country = F.lit(None).cast("string")
    for i, c in enumerate(COUNTRIES):
        country = F.when(number == i, c).otherwise(country)
    return li.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("int").alias(ID),
        F.when(F.col("_code") % 2 == 1, "Debit").otherwise("Credit").alias(SIGN),
        F.col(AMT),
        country.alias(CTRY),
        *more,
    )


def tx_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tx_lines`` with the month of the order in ``period``."""
    month = _table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("period"))
    lines = _tx_lines(spark, sf_dir, "l_orderkey")
    return lines.join(month, F.col("l_orderkey") == F.col("o_orderkey")).drop("l_orderkey", "o_orderkey")


def tx_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per order; about 10 per customer, close to the published profile."""
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    key = F.col("o_orderkey")
    country = (
        F.when(key % 1000 < 10, "RO")
        .when(key % 1000 < 13, "RU")
        .when(key % 1000 < 16, "PL")
        .when(key % 1000 < 19, "CY")
        .when(key % 3 == 0, "FI")
        .when(key % 3 == 1, "DK")
        .otherwise("SE")
    )
    sign = F.when(key % 5 < 2, "Debit").otherwise("Credit")
    amount = F.when(key % 1500 == 7, F.lit(-1)).otherwise(F.lit(1)) * F.floor(F.col("o_totalprice") / 50).cast("int")
    return o.select(
        F.col("o_custkey").cast("int").alias(ID),
        sign.alias(SIGN),
        amount.cast("int").alias(AMT),
        country.alias(CTRY),
    )


def dirty_lines(tx: DataFrame) -> DataFrame:
    """``;``-separated text lines (column ``value``) of transactions. The amount's remainder by
    20 decides which ones are spoilt: a field missing, no whole amount, country too long, sign
    too long, sign in lower case, a field too many, an id that is no number."""
    cid, sign, amount, country = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (ID, SIGN, AMT, CTRY))

    def line(*fields: Column) -> Column:
        return F.concat_ws(";", *fields)

    spoilt = [
        line(cid, sign, amount),
        line(cid, sign, F.concat(amount, F.lit(".5")), country),
        line(cid, sign, amount, F.concat(country, F.lit("xyz"))),
        line(cid, F.concat(sign, F.lit("-transfer")), amount, country),
        line(cid, F.lower(sign), amount, country),
        line(cid, sign, amount, country, F.lit("x")),
        line(F.concat(F.lit("A"), cid), sign, amount, country),
    ]
    kind = F.abs(F.col(AMT)) % 20
    value = F.when(kind == 1, spoilt[0])
    for k, text in enumerate(spoilt[1:], start=2):
        value = value.when(kind == k, text)
    return tx.select(value.otherwise(line(cid, sign, amount, country)).alias("value"))


FIXTURES = {"tx_lines": tx_lines, "tx_orders": tx_orders, "tx_months": tx_months}
