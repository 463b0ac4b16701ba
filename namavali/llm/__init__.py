"""Operators for large text corpora: extraction, deduplication, filtering, scoring, packing and tokenizing."""
