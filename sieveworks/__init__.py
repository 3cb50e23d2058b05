"""Spark-native analytics for captured web records."""

__version__ = "0.1.0"
