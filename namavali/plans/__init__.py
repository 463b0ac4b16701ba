"""Whole queries, the synthetic roll they run on, and the same queries in SQL."""
