"""Spark-native operators over discussion, article, page and transcript corpora."""
