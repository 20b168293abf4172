"""Operators for preparing training text: filters, near-duplicates, scoring, formatting and packing."""
