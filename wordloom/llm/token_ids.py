"""Token ids of whole texts by the tokenizers library, with a bounded memory of words.

The vocabulary lower-cases, drops white space and never joins across it, so the ids of a
text are those of its words in order. A text of printable ASCII and Latin letters, which the
vocabulary's normal form leaves as they are but for their case, is cut by the vocabulary's own
pattern, the parts go to its merges, and their ids are remembered as bytes. Any other text is
cut at blanks, tabs and line ends; its words go the same way where they can, and otherwise
through the library's whole chain.
"""

from __future__ import annotations

import re
import struct

from tokenizers import Tokenizer

VOCABULARY = "word_bpe_49k.json"
WORDS = 100_000
PARTS_KEPT = 800_000
LONGEST = 40

# Printable ASCII, the letters from U+00C0 to U+00FF, and the blanks between words.
PLAIN = re.compile("[ \n\t\r!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
# The vocabulary's own split pattern over them in lower case.
_LETTER = "a-z\u00df-\u00f6\u00f8-\u00ff"
PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^ \n\t\r{_LETTER}0-9]+")


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write the bytes of those letters: a printable byte as its
    own character, the others counted on from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in printable]
    letter = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(other)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Memory(dict):
    """Ids of words as little-endian unsigned 32-bit numbers; emptied when it is full."""

    def __init__(self, make, most: int) -> None:
        self.make, self.most = make, most

    def __missing__(self, word: str) -> bytes:
        ids = self.make(word)
        if len(word) <= LONGEST:
            if len(self) >= self.most:
                self.clear()
            self[word] = ids
        return ids


class TokenIds:
    """``TokenIds(path)(text)`` gives the ids of the text without special tokens."""

    def __init__(self, path: str) -> None:
        self.whole = Tokenizer.from_file(path)
        self.merges = self.whole.model
        self.letters = _byte_letters()
        self.part = Memory(self._part, PARTS_KEPT)
        self.word = Memory(self._word, WORDS)

    def _part(self, part: str) -> bytes:
        if not part.isascii():
            part = part.translate(self.letters)
        return packed([x.id for x in self.merges.tokenize(part)])

    def _plain(self, text: str) -> bytes | None:
        if "<|" in text or not PLAIN.fullmatch(text):
            return None
        return b"".join(map(self.part.__getitem__, PARTS.findall(text.lower())))

    def _word(self, word: str) -> bytes:
        ids = self._plain(word)
        if ids is None:
            ids = packed(self.whole.encode(word, add_special_tokens=False).ids)
        return ids

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        ids = self._plain(text)
        if ids is not None:
            return ids
        for space in "\n\t\r":
            text = text.replace(space, " ")
        return b"".join(map(self.word.__getitem__, text.split(" ")))


_loaded: dict[str, TokenIds] = {}


def token_ids(path: str) -> TokenIds:
    """One per Python worker and vocabulary."""
    if path not in _loaded:
        _loaded[path] = TokenIds(path)
    return _loaded[path]
