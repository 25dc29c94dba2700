"""Training-data operators: search, scoring, counting, deduplication, mixing.

Nothing outside this subpackage imports it.
"""
