"""Spark-native normalisation of decorated, tab-separated catalogs."""
