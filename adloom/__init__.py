"""Spark-native analytics for marketplace advertising and retail sales data."""
