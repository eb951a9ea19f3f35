"""Column expressions and order statistics built from Spark built-ins only."""
