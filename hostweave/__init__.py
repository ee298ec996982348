"""Spark-native analytics over very large directed host graphs."""

__version__ = "0.1.0"
