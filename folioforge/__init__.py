"""Spark-native engine that turns immutable texts into addressable, verifiable facts."""

__version__ = "0.1.0"
