"""Delivery-sales warehouse on Spark: load job, analytical queries and report views."""

__version__ = "0.1.0"
