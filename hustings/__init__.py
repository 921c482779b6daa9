"""Spark-native preparation, validation and serving of nested reference data."""
