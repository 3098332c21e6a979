"""Seasonal-forecast post-processing as Spark DataFrame operations."""
