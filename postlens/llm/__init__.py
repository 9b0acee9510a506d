"""Operators for preparing training data: scoring, filtering, near duplicates, mixing and packing."""
