"""Declared schema of the transaction table.

The file has four fields and no header. Lengths (sign <= 10, country <= 2) are not
expressible as Spark ``varchar`` in a DataFrame schema, so they are checked at load.
"""

from pyspark.sql import types as T

ID = "CustomerID"
SIGN = "TransactionSign"
AMT = "TransactionAmount"
CTRY = "TransactionCountry"
COLUMNS = (ID, SIGN, AMT, CTRY)
CORRUPT = "_corrupt_record"

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField(ID, T.IntegerType(), True),
        T.StructField(SIGN, T.StringType(), True),
        T.StructField(AMT, T.IntegerType(), True),
        T.StructField(CTRY, T.StringType(), True),
    ]
)

# Reader schema: the declared columns plus the raw text of lines that fail to parse.
READ_SCHEMA = T.StructType(TRANSACTION_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType(), True)])
