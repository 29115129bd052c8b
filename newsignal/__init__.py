"""Relate news sentiment to price series with Spark DataFrames."""

__version__ = "0.1.0"
