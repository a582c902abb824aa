"""Prepare and judge chat training data with Spark DataFrames."""
