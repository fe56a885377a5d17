"""Retail order-line analytics on Spark DataFrames."""
