"""Spark-native analytics over person, incident and service-coverage tables."""
