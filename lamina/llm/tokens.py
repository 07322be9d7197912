"""Word-level tokenisation: split a text into the tokenizer's words, encode each distinct word once.

The splitters equal the tokenizers library's own pre-tokenisation. Texts of plain Latin
characters take a pattern over explicit character classes; any other text goes through the
library itself, so that no difference between Unicode versions can matter.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np

#: Characters on whose class, case and normal form all Unicode versions in use agree.
PLAIN = [chr(c) for c in (9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x130), *range(0x131, 0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F), 0x20AC)]
_set = lambda kind: "".join(re.escape(c) for c in PLAIN if unicodedata.category(c)[0] == kind)
L, N, ALL = _set("L"), _set("N"), "".join(map(re.escape, PLAIN))
OTHER_THAN_PLAIN = re.compile(f"[^{ALL}]")
CONTRACTED = "'s|'t|'re|'ve|'m|'ll|'d"
BYTE_WORDS = re.compile(rf" ?[{L}]+|{CONTRACTED}| ?[{N}]+| ?[^\s{L}{N}]+|\s+(?!\S)|\s+")
LOWER_WORDS = re.compile(rf"[{L}]+|{CONTRACTED}|[{N}]|[^\s{L}{N}]+")

#: Words up to this length are kept in a worker's cache, of which there are at most so many.
CACHED_LENGTH, CACHED_WORDS = 48, 400_000


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def load(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


SHOWN = {b: c for b, c in enumerate(byte_alphabet())}
BYTE_OF = {c: b for b, c in SHOWN.items()}


class Words(dict):
    """word -> its ids as little-endian unsigned 32-bit bytes; each distinct word is encoded once per worker."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = load(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def encode(self, word: str) -> bytes:
        tokens = self.model.tokenize(word.encode().decode("latin-1").translate(SHOWN))
        return np.array([t.id for t in tokens], "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = ids
        return ids


@lru_cache(maxsize=4)
def words_of(path: str) -> Words:
    return Words(path)


def lower_ids(text: str, words: Words) -> bytes:
    """ids of a text under a lower-casing word vocabulary, as the library encodes it."""
    if any(s in text for s in words.special) or (not text.isascii() and OTHER_THAN_PLAIN.search(text)) or (text.isascii() and ODD_ASCII.search(text)):
        return np.array(words.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    return b"".join(map(words.__getitem__, LOWER_WORDS.findall(text.lower())))


#: Control characters whose membership in white space differs between pattern engines.
ODD_ASCII = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")


def byte_words(text: str, words: Words) -> list[str]:
    """A text's words under a byte-level vocabulary, special tokens as words of their own; their concatenation is the text."""
    for s in words.special:
        if s in text:
            out: list[str] = []
            for k, part in enumerate(text.split(s)):
                out += ([s] if k else []) + byte_words(part, words)
            return out
    if (not text.isascii() and OTHER_THAN_PLAIN.search(text)) or (text.isascii() and ODD_ASCII.search(text)):
        return [text[a:b] for _, (a, b) in words.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
    return BYTE_WORDS.findall(text)
