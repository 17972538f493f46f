"""Spark-native analytics for multi-version business records."""
