"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token's bytes form a linked list. Each merge rank has a bucket of list positions whose pair it would
merge; a two-level bitmap over the ranks marks the buckets in use, and find-first-set on each level gives the
lowest rank in a constant number of steps. Entries whose pair has changed meanwhile are skipped when
they come up. A pre-token of n bytes costs O(n log n) at worst, however long it is.

Defined cases: a null text counts as empty; an empty text has no ids and decodes to no bytes; equal rows give
equal rows; other columns pass through, except those named like an output. An id outside the vocabulary raises
when decoded.
"""

from __future__ import annotations

import base64
from array import array
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .base import with_columns

#: Pre-tokens over this many characters are encoded each time; shorter ones are remembered.
REMEMBERED_CHARS = 64
#: Remembered pre-tokens in each of two generations; the older is dropped when the younger is full.
GENERATION = 1 << 18
#: Bits of a word of the lower bitmap level.
SHIFT, MASK = 8, 255
BIT = [1 << k for k in range(MASK + 1)]


class BytePairCoder:
    """Encodes texts to ids and back by a rank file, each match of the split pattern on its own, without special tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.words: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
        for word, rank in ranks.items():
            self.words[rank] = word
        self.split = regex.compile(pattern).findall
        self.low = [0] * ((len(self.words) >> SHIFT) + 1)  # ranks in use, in words; empty between calls
        self.known = _Remembered(self)

    def encode_piece(self, piece: bytes) -> list[int]:
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return [whole]
        n, get, low = len(piece), ranks.get, self.low
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [get(piece[i : i + 2], -1) for i in range(n)]  # rank of the pair that begins here; -1: none, or merged away
        pair[-1] = -1
        top, buckets = 0, {}  # words in use; positions by rank, each a heap
        fresh = list(enumerate(pair))
        while True:
            for i, rank in fresh:
                if rank >= 0:
                    if rank in buckets:
                        heappush(buckets[rank], i)
                    else:
                        buckets[rank] = [i]
                        word = rank >> SHIFT
                        bits = low[word]
                        if not bits:
                            top |= 1 << word
                        low[word] = bits | BIT[rank & MASK]
            if not top:
                break
            word = (top & -top).bit_length() - 1
            bits = low[word]
            first = bits & -bits
            rank = word << SHIFT | first.bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                low[word] = bits = bits ^ first
                if not bits:
                    top &= top - 1
            if pair[i] != rank:
                fresh = ()
                continue
            j = after[i]
            k = after[i] = after[j]
            pair[j] = -1
            if k < n:
                before[k] = i
                pair[i] = get(piece[i : after[k]], -1)
            else:
                pair[i] = -1
            h = before[i]
            if h >= 0:
                pair[h] = get(piece[h:k], -1)
                fresh = ((h, pair[h]), (i, pair[i]))
            else:
                fresh = ((i, pair[i]),)
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : after[i]]])
            i = after[i]
        return out

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.known.__getitem__, self.split(text))) if text else b""

    def decode(self, ids: bytes | None) -> bytes:
        words = self.words
        return b"".join([words[i] for i in array("I", ids or b"")])


class _Remembered(dict):
    """Packed ids of recent pre-tokens, in two generations of bounded size."""

    def __init__(self, coder: BytePairCoder):
        self.coder, self.old = coder, {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.old.get(piece)
        if packed is None:
            packed = array("I", self.coder.encode_piece(piece.encode())).tobytes()
        if len(piece) <= REMEMBERED_CHARS:
            if len(self) >= GENERATION:
                self.old = dict(self)
                self.clear()
            self[piece] = packed
        return packed


@lru_cache(maxsize=4)
def coder(path: str, pattern: str) -> BytePairCoder:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, filter(bytes.strip, lines))}
    return BytePairCoder(ranks, pattern)


def encode(df: DataFrame, vocabulary: str, pattern: str, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Adds token_ids (binary: little-endian unsigned 32-bit ids) and n_tokens."""

    def run(texts: list) -> list[list]:
        ids = [coder(vocabulary, pattern).encode(t) for t in texts]
        return [ids, [len(x) // 4 for x in ids]]

    return with_columns(df, [text], run, pa.schema([("token_ids", pa.binary()), ("n_tokens", pa.int64())]), carry)


def decode(df: DataFrame, vocabulary: str, pattern: str, ids: str = "token_ids", carry: list[str] | None = None) -> DataFrame:
    """Adds decoded (binary: the bytes of the ids; null ids count as none)."""
    return with_columns(df, [ids], lambda packed: [[coder(vocabulary, pattern).decode(x) for x in packed]], pa.schema([("decoded", pa.binary())]), carry)


def round_trip(df: DataFrame, vocabulary: str, pattern: str, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """encode and decode in one pass: adds token_ids, n_tokens and decoded. One worker a task holds the remembered pre-tokens,
    where two passes would need two."""

    def run(texts: list) -> list[list]:
        made = coder(vocabulary, pattern)
        ids = [made.encode(t) for t in texts]
        return [ids, [len(x) // 4 for x in ids], [made.decode(x) for x in ids]]

    return with_columns(df, [text], run, pa.schema([("token_ids", pa.binary()), ("n_tokens", pa.int64()), ("decoded", pa.binary())]), carry)
