"""Spark-native catalogue cleaning, recommendation and evaluation."""
