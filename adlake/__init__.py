"""Listing analytics on PySpark: DataFrame, SQL and Structured Streaming operators."""
