"""Spark-native batch analytics for product-safety notices."""
