"""Batch text search and analytics on Spark DataFrames."""

from wordloom.plans.search import SearchResult, search
from wordloom.sources import Corpus, QueryBatch, corpora, corpus, query_batch

__all__ = ["Corpus", "QueryBatch", "SearchResult", "corpora", "corpus", "query_batch", "search"]
