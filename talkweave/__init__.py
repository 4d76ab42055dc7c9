"""Spark-native toolkit for building and auditing spoken-dialogue datasets."""
