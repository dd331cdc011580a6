"""Operators for cleaning, deduplicating, scanning and packing text corpora.

Nothing outside this package imports it; ``queries`` holds its registered queries.
"""
