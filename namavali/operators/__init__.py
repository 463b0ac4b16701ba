"""Relational operators on pages, blocks and names."""
