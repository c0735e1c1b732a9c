"""Span-based text redaction and training-data preparation on Spark DataFrames."""
