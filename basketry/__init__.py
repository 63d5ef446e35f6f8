"""Retail transaction analytics as PySpark DataFrame jobs."""
