"""Order analytics on Spark: DataFrame-in, DataFrame-out report operators."""
