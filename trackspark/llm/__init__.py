"""Operators that prepare training data: deduplication, decontamination, scoring, mixing, search."""
