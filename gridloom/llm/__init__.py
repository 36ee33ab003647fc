"""Operators for building training text: tokens, duplicates, contamination, toxicity, extraction, URL rules."""
