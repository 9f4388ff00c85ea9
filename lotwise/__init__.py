"""Marketplace observation analytics as PySpark DataFrame jobs."""
