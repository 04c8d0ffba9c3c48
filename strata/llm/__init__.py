"""Operators for preparing language-model training data, run as Spark jobs."""
