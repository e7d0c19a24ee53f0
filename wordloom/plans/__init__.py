"""Whole searches: a batch of queries to matches, totals and word statistics."""

from wordloom.plans.search import SearchResult, search

__all__ = ["SearchResult", "search"]
