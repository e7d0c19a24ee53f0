"""Operators on corpora, matches and attributes."""
