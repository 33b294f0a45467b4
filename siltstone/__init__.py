"""Siltstone: web-archive text analytics on Spark DataFrames."""
