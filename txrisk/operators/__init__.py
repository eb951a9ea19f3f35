"""User-level operators: DataFrame (+ RiskConfig) -> DataFrame, all lazy."""
