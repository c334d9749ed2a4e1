"""Operators that prepare training data: deduplication, scoring, extraction, masking, mixing, search."""
