"""Telecom usage analytics on Spark: Bronze to Silver to Gold, serving and churn."""

__version__ = "0.1.0"
