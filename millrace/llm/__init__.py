"""Operators for training data: deduplication, classifiers, filters, tokens, mixing and rendering."""
