"""Operators that prepare a text collection for training: deduplication, packing, scoring, screening."""
