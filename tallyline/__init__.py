"""Reusable business-analytics operators for Spark DataFrames."""
