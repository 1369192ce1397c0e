"""Word hashing shared by the operators that learn from words."""

from __future__ import annotations

import zlib

import numpy as np

from ledgerline.llm.common import LOWER

# fixed values: symbols that become words of their own
MARKS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">", b"!")
CACHED_WORDS = 300_000


class WordHash(dict):
    """32-bit hash of a word, remembered; emptied when it gets large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = self[word] = zlib.crc32(word)
        return found


def spaced(raw: bytes) -> bytes:
    """Symbols set apart from the words they touch."""
    for mark in MARKS:
        if mark in raw:
            raw = raw.replace(mark, b" " + mark + b" ")
    return raw


def hashed_words(raw: bytes, hashes: WordHash, lower: bool = True) -> np.ndarray:
    """Hashes of the words of a text, symbols apart, as unsigned 64-bit."""
    raw = spaced(raw)
    words = (raw.translate(LOWER) if lower else raw).split()
    return np.array([hashes[w] for w in words], dtype=np.uint64)
