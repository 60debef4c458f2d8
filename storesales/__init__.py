"""Retail store-sales analytics on Spark DataFrames."""
