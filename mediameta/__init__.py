"""Spark-native preparation, extraction and scoring of filename metadata."""

__version__ = "0.1.0"
