"""Validated batch and streaming data flows on PySpark."""
