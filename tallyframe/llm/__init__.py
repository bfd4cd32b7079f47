"""Operators for preparing text corpora: counting, deduplicating, filtering, mixing, storing."""
