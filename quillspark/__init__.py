"""Spark-native preparation and scoring of language-model training tables."""
