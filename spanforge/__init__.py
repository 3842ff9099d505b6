"""Spark-native analytics over interval evidence, sequences and feature graphs."""
