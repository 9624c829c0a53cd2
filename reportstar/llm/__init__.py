"""Operators for large text corpora: deduplication, extraction, filters, scoring and mixing."""
