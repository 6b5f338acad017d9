"""Operators for preparing training text: deduplication, filtering, extraction, mixing, encoding.

Nothing else in the library imports this subpackage; it can be removed as a whole.
"""
