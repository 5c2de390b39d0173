"""Spark-native subscriber retention analytics."""
