"""Spark-native analytics for inspection and equipment-history tables."""
