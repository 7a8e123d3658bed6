"""Table operations for Spark: DataFrame in, DataFrame out, plus a few streaming jobs."""
