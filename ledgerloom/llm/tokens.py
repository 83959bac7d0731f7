"""Tokenizing whole texts with the ``tokenizers`` library, word by word through a bounded cache.

Both tokenizer families cut texts at white space before they merge anything, so a text's ids are
the ids of its words in order. Words repeat; texts don't. A text in which a cut could fall
elsewhere (runs of white space, tabs and other rare separators) goes through the tokenizer whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

#: White space other than blank and line feed, as Python or the tokenizers' patterns know it.
RARE_SPACE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0 ᠎ -​    　﻿]")

#: Words that a worker keeps between batches. Frequent words come early; once full it takes no more.
CACHE_WORDS = 1_000_000
#: Runs of punctuation that it keeps, and the longest word that it does.
CACHE_TAILS, CACHE_CHARS = 10_000, 64

#: A word with the blank before it and punctuation behind it: two units of either pattern.
LATIN_WORD = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)").fullmatch
#: Byte-level vocabularies write the bytes that aren't printable in Latin-1 as the characters from 256 on, in order.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
BYTE_CHARACTERS = {b: chr(256 + k) for k, b in enumerate(_HIDDEN)}

_loaded: dict[tuple[str, str], TextEncoder] = {}


class TextEncoder:
    """``ids(texts)``: for each whole text, its ids as bytes of little-endian 32-bit integers.

    ``kind`` is "byte" for a byte-level vocabulary, where a blank belongs to the word after it, or
    "word" for a vocabulary whose patterns drop white space.
    """

    def __init__(self, path: str, kind: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.packed = [k.to_bytes(4, "little") for k in range(max(self.tokenizer.get_vocab().values()) + 1)]
        self.kind = kind
        self.known = Known(self.word)
        self.tails: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def plain(self, text: str) -> bool:
        """May this text be cut at its blanks and line feeds?"""
        if "<|" in text or RARE_SPACE.search(text):
            return False
        return self.kind == "word" or not (
            "  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[-1:] == " " or text[:1] == " "
        )

    def words(self, text: str) -> list[str]:
        """The cached units of a plain text; byte-level ones keep their blank, and lines a line feed."""
        if self.kind == "word":
            return text.split()
        return text.replace("\n", " \n ").replace(" ", "\0 ").replace("\0 \n\0 ", "\0\n\0").split("\0")

    def word(self, word: str) -> bytes:
        """The ids of a word: a Latin one straight from the model in the two units that the tokenizer's
        patterns make of it and the punctuation behind it, any other through the whole tokenizer."""
        if not (found := LATIN_WORD(word)):
            return self.whole(word)
        head, tail = found.groups()
        if not tail:
            return self.model(head)
        if (more := self.tails.get(tail)) is None:
            more = self.model(tail)
            if len(self.tails) < CACHE_TAILS:
                self.tails[tail] = more
        return self.known[head] + more  # the bare word comes as well, or with other punctuation

    def model(self, unit: str) -> bytes:
        """The ids of one unit of the patterns, by the tokenizer's model, which reads characters that stand for bytes."""
        if self.kind == "word":
            unit = unit.lower()
        if not unit.isascii():
            unit = unit.encode().decode("latin-1").translate(BYTE_CHARACTERS)
        elif unit[0] == " ":
            unit = BYTE_CHARACTERS[32] + unit[1:]
        return b"".join([self.packed[x.id] for x in self.tokenize(unit)])

    def ids(self, texts: list[str]) -> list[bytes]:
        known = self.known.__getitem__
        return [b"".join(map(known, self.words(x))) if self.plain(x) else self.whole(x) for x in texts]


class Known(dict):
    """The ids of words; those of a new word are made when it is asked for, and kept while there is room."""

    def __init__(self, ids_of: Callable[[str], bytes]):
        super().__init__()
        self.ids_of = ids_of

    def __missing__(self, word: str) -> bytes:
        ids = self.ids_of(word)
        if len(self) < CACHE_WORDS and len(word) <= CACHE_CHARS:
            self[word] = ids
        return ids


def encoder(path: str, kind: str) -> TextEncoder:
    """One encoder for each Python worker."""
    if (path, kind) not in _loaded:
        _loaded[path, kind] = TextEncoder(path, kind)
    return _loaded[path, kind]


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)
