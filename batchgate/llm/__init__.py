"""Operators a training-data pipeline needs, each on Spark DataFrames."""
