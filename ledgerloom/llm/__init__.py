"""Operators for training data: filters, duplicate removal, scoring and mixing of texts."""
