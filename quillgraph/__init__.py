"""Spark-native analytics for data-dictionary property graphs."""
