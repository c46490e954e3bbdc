"""Operators for large training-data corpora: filters, mixing, deduplication, scans, formatting."""
