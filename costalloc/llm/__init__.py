"""Operators that prepare training data: filters, duplicate removal, scoring, packing."""
