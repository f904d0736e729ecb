"""Operators for building training corpora: tokenising, cleaning, deduplicating and mixing documents."""
