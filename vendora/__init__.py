"""Spark-native product-market analytics over multi-source catalogues."""
