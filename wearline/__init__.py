"""Incremental sensor analytics on PySpark: layered tables, change feed, serving."""
