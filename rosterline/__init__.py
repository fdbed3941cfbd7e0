"""Workforce-records operators for Spark: DataFrame in, DataFrame out."""
