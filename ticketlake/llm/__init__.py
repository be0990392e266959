"""Operators that prepare training text: scans, filters, deduplication, search and mixing."""
