"""Spark-native operators for evaluation-feedback analytics."""
