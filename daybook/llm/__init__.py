"""Operators for preparing training text: search, near-duplicates, scoring, mixing, packing, sharding."""
