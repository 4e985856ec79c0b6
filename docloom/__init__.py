"""Spark-native document-to-knowledge analytics."""
