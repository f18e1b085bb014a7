"""Review-text analytics on Spark: DataFrame in, DataFrame out."""
