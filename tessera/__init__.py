"""Spark-native document-to-structure analytics."""

__version__ = "0.1.0"
