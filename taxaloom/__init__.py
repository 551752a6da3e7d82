"""Spark-native analytics for large cohorts of sequences, partitions, trees, search hits and runs."""
