"""Operators for preparing language-model training data, each with a query over the given tables."""
