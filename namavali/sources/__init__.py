"""Readers of pages and name lists, and writers of results."""
