"""Refund analytics for e-commerce transactions, expressed as Spark DataFrame jobs."""

__version__ = "0.1.0"
