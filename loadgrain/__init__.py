"""Electrical-load time series on Spark: every operator maps DataFrames to DataFrames."""
