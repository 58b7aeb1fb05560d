"""Browsing-history and training-data engine on Spark DataFrames."""
