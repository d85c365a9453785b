"""Retail lakehouse analytics as distributed Spark jobs."""

__version__ = "0.1.0"
