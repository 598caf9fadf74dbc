"""Operators for preparing language-model training data, each a DataFrame job on Spark."""
