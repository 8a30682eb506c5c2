"""Spark-native analytics for wind-and-wave observation series."""

__version__ = "0.1.0"
