"""Token ids of texts under a given public vocabulary, as little-endian bytes."""

from __future__ import annotations

import base64
import re

import numpy as np
import tiktoken

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the split pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces of text whose ids a worker remembers.
REMEMBERED = 500_000
_UNSPLIT = re.compile(r" (?=\s|\Z)")


class _Pieces(dict):
    """Ids of ' ' + piece, made when first asked for."""

    def __init__(self, encoding: tiktoken.Encoding, dtype: str):
        super().__init__()
        self.encoding, self.dtype = encoding, dtype

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = self[piece] = np.array(self.encoding.encode_ordinary(" " + piece), self.dtype).tobytes()
        return ids


def read_vocabulary(path: str = VOCABULARY, pattern: str = PATTERN) -> dict:
    """Ranks and pattern as plain data of a megabyte, to be broadcast; read on the driver."""
    with open(path, "rb") as lines:
        return {"ranks": {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, "pattern": pattern}


def vocabulary_of(value: dict) -> Vocabulary:
    """The vocabulary of a broadcast value, built once a Python worker."""
    if "built" not in value:
        value["built"] = Vocabulary(value["ranks"], value["pattern"])
    return value["built"]


class Vocabulary:
    """A byte-pair vocabulary. The first id that is free ends documents."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.end = max(ranks.values()) + 1
        self.dtype = "<u2" if self.end < 1 << 16 else "<u4"
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pieces = _Pieces(self.encoding, self.dtype)

    def encode(self, text: str | None) -> bytes:
        """Ids of a text. A space before other text always begins a piece of the pattern, so pieces are remembered."""
        if not text:
            return b""
        if _UNSPLIT.search(text):
            return np.array(self.encoding.encode_ordinary(text), self.dtype).tobytes()
        first, *rest = text.split(" ")
        head = np.array(self.encoding.encode_ordinary(first), self.dtype).tobytes() if first else b""
        return head + b"".join(map(self.pieces.__getitem__, rest))
