"""Byte-level BPE ids of whole texts, with a bounded cache of the ids of space-separated chunks.

The vocabulary file is one of the public tokenizers; its place is a parameter and nothing of it is
kept in the repository.  The ids equal those of the ``tokenizers`` library for the same vocabulary
(``encode_special_tokens`` on, no special tokens added): the pre-tokenisation pattern never lets a
token run over a lone space or line feed that stands between two other characters, so a text can be
cut there and each chunk encoded, and looked up, by itself.  Texts with two white-space characters in
a row are encoded whole.
"""

from __future__ import annotations

import base64
import json
import re

import numpy as np
import tiktoken

RANKS = "byte_bpe_50k.tiktoken"
ADDED = "byte_bpe_50k.json"
EOD = 50256
#: Entries of the cache; some 50 MB at most.
CACHE = 200_000

_RUN = re.compile(r"\s\s")


class Encoder:
    """``encode(text)``: the ids as little-endian unsigned 16-bit bytes."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("chunks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.cache: dict[str, bytes] = {}

    def _direct(self, text: str) -> bytes:
        return np.array(self.bpe.encode_ordinary(text), dtype="<u2").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        got = self.cache.get(chunk)
        if got is None:
            if "\n" in chunk[1:-1] and not chunk.startswith("\n") and not chunk.endswith("\n"):
                parts = chunk.split("\n")
                line = self._chunk("\n") if len(chunk) > 1 else self._direct(chunk)
                return line.join(map(self._chunk, parts))
            got = self._direct(chunk)
            if len(self.cache) < CACHE and len(chunk) < 64:
                self.cache[chunk] = got
        return got

    def encode(self, text: str) -> bytes:
        if _RUN.search(text):
            return self._direct(text)
        first, *rest = text.split(" ")
        get, chunk = self.cache.get, self._chunk
        out = [chunk(first)] if first else []
        for word in rest:
            word = " " + word
            out.append(get(word) or chunk(word))
        return b"".join(out)

    def encode_added(self, text: str, added: dict[str, int]) -> bytes:
        """As ``encode``, but the strings ``added`` inside the text become their ids; the text between two of them is encoded by itself."""
        if not any(token in text for token in added):
            return self.encode(text)
        cuts = re.split("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")", text)
        return b"".join(np.array([added[part]], dtype="<u2").tobytes() if i % 2 else self.encode(part) for i, part in enumerate(cuts))


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of this Python worker, kept from task to task."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(path, pattern)
    return _encoders[path, pattern]


def added_tokens(name: str = ADDED) -> dict[str, int]:
    """The tokens that a public tokenizer has beside its vocabulary, and recognises inside texts, with their ids."""
    import public_tokenizers
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


def vocabulary(name: str = RANKS) -> tuple[str, str]:
    """(path, pre-tokenisation pattern) of a public byte-level vocabulary."""
    import public_tokenizers
    return public_tokenizers.path(name), public_tokenizers.PATTERN
