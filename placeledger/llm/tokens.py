"""Token ids of whole texts, by the tokenizers library, with each word encoded once.

Both public vocabularies cut a text at white space before they merge anything: a chunk of
white space and the word after it is encoded alike alone and in its text. Chunks repeat, so
a worker keeps the ids of those it met; two bounded dictionaries let the rare ones go.
"""

from __future__ import annotations

import re
from array import array
from functools import cache

import public_tokenizers
from tokenizers import Tokenizer

CHUNK = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
# Characters that a Unicode-aware pattern may or may not call white space.
ODD = re.compile(r"[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")
KEPT = 600_000
KEPT_ONCE = 200_000
# Characters of the longest chunk that is kept: with the numbers above a bound in bytes.
KEPT_CHARS = 64


class ChunkIds(dict):
    """Little-endian 32-bit ids of a chunk, as bytes.

    A chunk starts in `once`; when it comes again it moves up. Each dictionary is emptied
    when it is full, which bounds a worker's memory whatever it reads.
    """

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        self.once: dict[str, bytes] = {}
        # Some vocabularies see neither white space nor the case of ASCII letters.
        self.plain = self.encode(" \nA") == self.encode("a")

    def encode(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        if len(chunk) > KEPT_CHARS:
            return self.encode(chunk)
        ids = self.once.pop(chunk, None)
        if ids is not None:
            if len(self) >= KEPT:
                self.clear()
            self[chunk] = ids
            return ids
        # A word and the one mark behind it are separate pieces for both vocabularies.
        if chunk[-1] in ",." and chunk[:-1].lstrip().isalpha():
            ids = self[chunk[:-1]] + self[chunk[-1]]
        else:
            ids = self.encode(chunk)
        if len(self.once) >= KEPT_ONCE:
            self.once.clear()
        self.once[chunk] = ids
        return ids


@cache
def vocabulary(name: str) -> ChunkIds:
    """One per worker process; `name` is a file of public_tokenizers."""
    return ChunkIds(Tokenizer.from_file(public_tokenizers.path(name)))


def ids_of(text: str, known: ChunkIds) -> bytes:
    """All ids of a text, 4 bytes each."""
    if ODD.search(text):
        return known.encode(text)
    if known.plain and "<|" not in text:  # else a special token might be made or unmade
        chunks = (text.lower() if text.isascii() else text).split()
    else:
        chunks = CHUNK.findall(text)
    return b"".join(map(known.__getitem__, chunks))


def token_ids(text: str | None, name: str) -> bytes:
    """All ids of the text, 4 bytes each; none for null and empty texts."""
    return ids_of(text, vocabulary(name)) if text else b""
