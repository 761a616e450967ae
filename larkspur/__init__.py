"""Spark operators for the data work around a tabular classifier."""
