"""Tabular feature preparation, scoring and drift monitoring on Spark DataFrames."""

__version__ = "0.1.0"
