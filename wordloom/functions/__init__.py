"""Column functions."""

from wordloom.functions.text import as_float32, escape_text, words

__all__ = ["as_float32", "escape_text", "words"]
