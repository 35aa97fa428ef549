"""Operators for preparing training data: scoring, filtering, deduplication, mixing, encoding."""
