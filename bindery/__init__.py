"""Spark-native analytics for genomic binding-site data."""
