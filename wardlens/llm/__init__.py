"""Operators for preparing training data: scoring, mixing, sharding, archives, duplicates, packing."""
