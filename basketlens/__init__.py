"""Retail purchase-history analytics and two-stage recommendation as Spark jobs."""

__version__ = "0.1.0"
