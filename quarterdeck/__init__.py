"""Spark-native analytics over institutional-holdings disclosures."""
