"""Spark-native document preparation, chunking and retrieval analytics."""
