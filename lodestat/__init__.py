"""Lodestat: trip statistics, text vectors, classifiers and clustering as Spark DataFrame operators."""
