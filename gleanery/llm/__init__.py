"""Operators for preparing training corpora: dedup, mixing, packing, search, scoring."""
