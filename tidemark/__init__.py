"""Spark-native risk analytics: books, metrics, monitoring and data quality."""
