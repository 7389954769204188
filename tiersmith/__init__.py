"""Medallion analytics on Spark DataFrames: landing, cleaning, quality, star schema and training analytics."""

__version__ = "0.1.0"
