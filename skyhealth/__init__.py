"""Spark-native environmental-health analytics engine."""
__version__ = "0.1.0"
