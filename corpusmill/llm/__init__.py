"""Operators for training data: search, deduplication, classifiers, extraction, tokens, packing."""
