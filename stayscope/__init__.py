"""Review analytics on Spark: DataFrame operators from raw table to fitted model."""
