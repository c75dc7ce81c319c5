"""Spark-native cohort feature, encoding and scoring engine."""
