"""Brute force in plain Python, for small fixtures."""

import math

import regex

WORD = regex.compile(r"[\p{L}\p{N}]+")


def words(text):
    return WORD.findall((text or "").lower())


def longest_run(query, text):
    """Longest stretch of the query found as a stretch of the text."""
    best = 0
    for i in range(len(query)):
        for j in range(i + 1, len(query) + 1):
            part = query[i:j]
            if any(text[k : k + len(part)] == part for k in range(len(text))):
                best = max(best, len(part))
    return best


def bm25(query, text, texts, k1=1.2, b=0.75):
    n = len(texts)
    average = sum(map(len, texts)) / n
    total = 0
    for term in dict.fromkeys(query):
        tf = text.count(term)
        if tf:
            df = sum(term in t for t in texts)
            idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
            norm = tf + k1 * (1 - b + b * len(text) / average)
            total += math.floor(idf * tf * (k1 + 1) / norm * 1_000_000 + 0.5)
    return total
