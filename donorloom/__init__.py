"""Donor analytics on Spark: every operator takes and returns lazy DataFrames."""

__version__ = "0.1.0"
