"""Operators for preparing training text: scoring, deduplication, search, encoding."""
