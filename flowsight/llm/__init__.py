"""Operators for training data: extraction, filters, near and exact duplicates, tokens, packing."""
