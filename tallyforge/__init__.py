"""Spark-native engine for semi-structured statements and analytic tables."""

__version__ = "0.1.0"
