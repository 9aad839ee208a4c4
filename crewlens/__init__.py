"""Staffing-operations analytics on Spark DataFrames."""
