"""Corpora: choosing, combining, tokenising, describing and saving them."""

from wordloom.sources.batch import QueryBatch, query_batch, validate_queries
from wordloom.sources.corpus import (
    Corpus,
    corpora,
    corpus,
    corpus_status,
    describe_corpus,
    load_prepared,
    prepare,
    read_parquet,
    save_prepared,
)
from wordloom.sources.term_index import TermIndex, load_index, save_index
from wordloom.sources.tokens import doc_terms, tokens

__all__ = [
    "Corpus",
    "QueryBatch",
    "TermIndex",
    "corpora",
    "corpus",
    "corpus_status",
    "describe_corpus",
    "doc_terms",
    "load_index",
    "load_prepared",
    "prepare",
    "query_batch",
    "read_parquet",
    "save_index",
    "save_prepared",
    "tokens",
    "validate_queries",
]
