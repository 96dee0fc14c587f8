"""Spark-native toolkit for turning ground-investigation files into a clean, queryable dataset."""
