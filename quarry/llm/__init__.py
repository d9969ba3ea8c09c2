"""Operators of a training-data pipeline (tokenising, deduplication, scoring,
archives, mixing).  Nothing outside this package imports it."""
