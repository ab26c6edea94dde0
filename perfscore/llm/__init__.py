"""Training-data operators: cleaning, deduplication, scoring, mixing, packing, encoding.

Nothing outside this subpackage imports it.
"""
