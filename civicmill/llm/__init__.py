"""Operators for preparing training text: sharding, cleaning, scoring, deduplication, packing."""
