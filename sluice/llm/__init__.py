"""Operators for preparing text corpora: dedup, scoring, formatting, filtering and packing."""
