"""Operators for training-data corpora, each a function from DataFrame to DataFrame."""
