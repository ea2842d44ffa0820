"""Operators for preparing training text: filters, deduplication, tokenising, sharding."""
