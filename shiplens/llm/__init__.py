"""Operators over a text corpus: filters, near-duplicates, mixing, extraction, counts.

Nothing else in the library imports this package.
"""
