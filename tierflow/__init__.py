"""Incremental Bronze / Silver / Gold tables for file-based sports data, on PySpark."""
