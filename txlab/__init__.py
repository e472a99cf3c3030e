"""Labelled bank-transaction analytics and data preparation on Spark DataFrames."""
