"""Problem 8: encoding of the corpus with a public byte-level tokenizer.

Forced-boundary splitting: a byte pair that occurs inside no vocabulary token can never be merged over, so
a text may be cut there. The table of pairs is computed from the vocabulary. Of the pairs it allows, the cuts
used first are those that are also ends of the tokenizer's own pre-tokens (before spaces, tabs and line ends that
follow another character), so a fragment encodes alone as it does in its text. Fragments that are still long, as those
of scripts without spaces, are cut again at forced pairs between two letters beyond ASCII, which lie inside one
pre-token. Fragments repeat, so each worker keeps the ids of those it has met (``memory`` entries at most) and encodes
only new ones; the ids of the fragments are concatenated.

Null and empty texts have the empty list. Special tokens' strings are ordinary text.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import list_array, map_rows

TOKENIZERS = "/opt/tokenizers"
NAME = "byte_bpe_50k"
MEMORY = 400_000
#: The pre-token pattern of byte_bpe_50k (fixed value of the public tokenizer).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def ranks(folder: str, name: str) -> dict[bytes, int]:
    with open(f"{folder}/{name}.tiktoken", "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def forced_pairs(vocabulary: dict[bytes, int]) -> np.ndarray:
    """256 x 256 table: True where the pair of bytes occurs inside no token."""
    free = np.ones((256, 256), dtype=bool)
    for token in vocabulary:
        for a, b in zip(token, token[1:]):
            free[a, b] = False
    return free


#: Fragments of more characters are cut again.
LONG = 64
#: A letter as the tokenizer's pattern counts it.
LETTER = regex.compile(r"\p{L}")

#: A run of these and what follows it up to the next run is a fragment.
GAP = " \t\n\r"


def blocked(free: np.ndarray) -> str:
    """The characters after which a gap is no forced boundary.

    A character counts by the last byte of its UTF-8 form, whose pair with every gap character must be free. White
    space is blocked too, as the pre-tokens look ahead over it, and so is all above U+2FFF, which only loses cuts.
    """
    ok = free[:, [ord(g) for g in GAP]].all(axis=1)
    return "".join(c for c in map(chr, range(0x3000)) if c not in GAP and (c.isspace() or not ok[ord(c) if ord(c) < 128 else 0x80 | (ord(c) & 0x3F)]))


class Encoder:
    """Encodes fragments; ``known`` keeps the ids of short ones as bytes of 32-bit integers."""

    def __init__(self, folder: str, name: str, memory: int):
        import tiktoken

        vocabulary = ranks(folder, name)
        self.bpe = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=vocabulary, special_tokens={})
        self.free = forced_pairs(vocabulary)
        self.blocked = frozenset(blocked(self.free))
        self.piece = re.compile(f"[{GAP}]*[^{GAP}]+|[{GAP}]+")
        self.known: dict[str, bytes] = {}
        self.memory = memory

    def fragments(self, text: str) -> list[str]:
        pieces = self.piece.findall(text)
        ends = {x[-1] for x in pieces}
        if self.blocked.isdisjoint(ends) and max(ends) < "\u3000":
            return pieces
        joined, open_end = [], False
        for piece in pieces:
            if open_end:
                joined[-1] += piece
            else:
                joined.append(piece)
            open_end = piece[-1] in self.blocked or piece[-1] >= "\u3000"
        return [x for piece in joined for x in (self.cut(piece) if len(piece) > LONG else (piece,))]

    def cut(self, piece: str) -> list[str]:
        """A long fragment at its forced pairs between letters beyond ASCII: no token holds such a pair, and no rule of
        the pre-tokens looks past two letters that stand side by side."""
        out, start = [], 0
        for at in range(1, len(piece)):
            a, b = piece[at - 1], piece[at]
            if a > "\x7f" and b > "\x7f" and at - start >= LONG // 4 and self.free[0x80 | (ord(a) & 0x3F), b.encode("utf-8", "surrogatepass")[0]] and LETTER.match(a) and LETTER.match(b):
                out.append(piece[start:at])
                start = at
        return [*out, piece[start:]]

    def encode(self, text: str) -> bytes:
        """The ids of a text that isn't empty, as packed 32-bit integers."""
        pieces = self.fragments(text)
        known = self.known
        if len(known) > self.memory:
            known.clear()
        long = []
        for piece in set(pieces).difference(known):
            known[piece] = np.array(self.bpe.encode_ordinary(piece), dtype=np.int32).tobytes()
            if len(piece) > 64:
                long.append(piece)
        got = b"".join(map(known.__getitem__, pieces))
        for piece in long:
            del known[piece]
        return got

    def count(self, text: str) -> int:
        return len(self.encode(text)) // 4


@lru_cache(maxsize=4)
def encoder(folder: str = TOKENIZERS, name: str = NAME, memory: int = MEMORY) -> Encoder:
    return Encoder(folder, name, memory)


def encode_documents(documents: DataFrame, folder: str = TOKENIZERS, name: str = NAME, memory: int = MEMORY) -> DataFrame:
    """doc_id and ids of every row of ``documents``; the empty list for null and empty texts."""

    def block(rows: dict) -> dict:
        enc = encoder(folder, name, memory)
        packed = [enc.encode(t) if t else b"" for t in rows["text"]]
        sizes = np.array([len(x) // 4 for x in packed], dtype=np.int32)
        return {"doc_id": rows["doc_id"], "ids": list_array(np.frombuffer(b"".join(packed), dtype=np.int32), sizes, pa.int32())}

    return map_rows(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), "doc_id bigint, ids array<int>", block)


def count_tokens(documents: DataFrame, keys: list[str], text: str = "text", folder: str = TOKENIZERS, name: str = NAME, memory: int = MEMORY) -> DataFrame:
    """``keys`` of every row and n_tokens of its text (0 for null)."""
    schema = ", ".join(f"`{k}` {documents.schema[k].dataType.simpleString()}" for k in keys) + ", n_tokens bigint"

    def block(rows: dict) -> dict:
        enc = encoder(folder, name, memory)
        return {k: rows[k] for k in keys} | {"n_tokens": [enc.count(t) if t else 0 for t in rows[text]]}

    return map_rows(documents.select(*keys, text), schema, block)
