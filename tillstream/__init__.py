"""Payments analytics on Spark: marts, checks, reshaping helpers and streaming jobs."""
