"""Adaptive context-mixing range coder for token ids.

Ids are coded as ranks: the caller numbers the ids of a segment from the most frequent on, so any vocabulary fits. Ranks
are cut into blocks of equal length; each block starts from the same fresh model, so any block can be read alone. Many
blocks advance together, one rank each a step, as lanes of NumPy arrays; arithmetic is on integers, but for a division of
doubles whose whole part is exact, so that every machine decodes alike.

A step codes one rank. Order 2 and order 1 each predict a rank from a hashed context, with an adaptive confidence; the hit
rates of their confidences are mixed by an adaptive weight into the shares of "order 2 is right" and "order 1 is right". The rest of
the interval goes to order 0: the segment's frequencies of the octaves of ranks (0, 1-2, 3-6, 7-14, ...), each cut evenly among
its ranks. The range coder keeps 60 bits and moves whole 16-bit words; carries are added to the words before at the end.
"""

from __future__ import annotations

import numpy as np

#: Longest block, shortest block, and lanes that advance together.
BLOCK, LEAST_BLOCK, LANES = 512, 256, 4096
#: Octaves of ranks at most, which bounds the distinct ids of a segment.
OCTAVES = 24
_TABLE = 128
_MASK = np.int64(_TABLE - 1)
_U16, _U44 = np.uint64(16), np.uint64(44)
_TOP, _LOW44, _SPAN = np.uint64(1 << 44), np.uint64((1 << 44) - 1), np.uint64(1 << 60)
#: Least share of an octave, of 2^16.
_LEAST = 96
#: Hit rate of a confidence, of 2^16. With a weight between 2048 and 63488, a share is 128 or more, and those of both
#: orders are 2^16 times 60000/65536 at most.
_RATE = np.minimum(4096 + 3600 * np.arange(16), 60000)


def octave(ranks: np.ndarray) -> np.ndarray:
    """Place of the highest bit of rank + 1."""
    return np.frexp((ranks + 1).astype(np.float64))[1].astype(np.int64) - 1


class _Model:
    """State of all lanes. predict() gives the shares of order 2 and 1; update() learns."""

    def __init__(self, lanes: int, counts: np.ndarray):
        """counts: ranks in each octave over the segment, which are order 0."""
        self.row_t = np.arange(lanes, dtype=np.int64) * _TABLE
        self.before = np.zeros(lanes, np.int64)  # of the rank before the last, hashed
        self.table1, self.table2 = np.zeros(lanes * _TABLE, np.int32), np.zeros(lanes * _TABLE, np.int32)  # rank << 4 | confidence
        self.weight = np.full(lanes, 1 << 15, np.int64)
        spare = (1 << 16) - _LEAST * len(counts)
        share = np.cumsum(counts.astype(np.int64)) * spare // max(1, int(counts.sum()))
        share[-1] = spare
        self.bounds = np.concatenate([[0], share]) + _LEAST * np.arange(len(counts) + 1)  # of octaves, cumulative shares of 2^16

    def predict(self, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """seen: the ranks before."""
        mixed = seen * 40503
        self.at1 = (seen & _MASK) + self.row_t
        self.at2 = ((mixed ^ self.before) & _MASK) + self.row_t
        self.before = mixed >> 3
        self.e1, self.e2 = self.table1.take(self.at1), self.table2.take(self.at2)
        self.p1, self.p2 = self.e1 >> 4, self.e2 >> 4
        self.c1, self.c2 = self.e1 & 15, self.e2 & 15
        agree = (self.p1 == self.p2).view(np.int8)
        second = self.weight * _RATE.take(self.c2) >> 16
        first = ((1 << 16) - self.weight) * _RATE.take(self.c1) >> 16
        shared = agree * first
        return second + shared, first - shared

    def update(self, ranks: np.ndarray, hit1: np.ndarray, hit2: np.ndarray) -> None:
        """hit1, hit2: which orders were right."""
        one, two = hit1.view(np.int8), hit2.view(np.int8)
        self.weight += _PULL.take(two - one) - (self.weight * (hit1 != hit2) >> 5)
        fresh = (ranks << 4).astype(np.int32)
        for table, at, entry, sure, hit in ((self.table1, self.at1, self.e1, self.c1, hit1), (self.table2, self.at2, self.e2, self.c2, hit2)):
            table[at] = np.where(hit, entry + (sure < 15), fresh)  # a wrong guess is replaced


#: What draws the weight, less a 32nd of itself, to 63488 where order 2 alone is right (1) and to 2048 where order 1 alone is (-1).
_PULL = np.array([0, 63488, 2048]) >> 5


def block_length(n: int) -> int:
    """Ids a block: such that LANES blocks hold n ids, between LEAST_BLOCK and BLOCK."""
    return max(LEAST_BLOCK, min(BLOCK, -(-n // LANES)))


def octave_counts(ranks: np.ndarray) -> np.ndarray:
    counts = np.bincount(octave(ranks), minlength=1)
    if len(counts) > OCTAVES:
        raise ValueError(f"more than 2^{OCTAVES} distinct ids in a segment")
    return counts


def encode(ranks: np.ndarray, length: int, counts: np.ndarray) -> list[bytes]:
    """One coded block for each `length` ranks; the last is filled up with rank 0."""
    blocks = -(-len(ranks) // length)
    filled = np.zeros(blocks * length, np.int32)
    filled[: len(ranks)] = ranks
    filled = filled.reshape(blocks, length)
    return [x for a in range(0, blocks, LANES) for x in _encode(filled[a : a + LANES], counts)]


def _encode(ranks: np.ndarray, counts: np.ndarray) -> list[bytes]:
    lanes, length = ranks.shape
    model = _Model(lanes, counts)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, _SPAN, np.uint64)
    width = length * 3 + 16  # a rank takes 11 bits at most for its order, 11 for its octave and 24 in it
    words = np.zeros(lanes * width, np.uint32)
    place = np.arange(lanes, dtype=np.int64) * width
    begin_of = place.copy()
    columns = np.ascontiguousarray(ranks.T).astype(np.int64)
    of = octave(np.arange(int(ranks.max()) + 1))
    begins, ends, firsts = model.bounds[of], model.bounds[of + 1], (1 << of) - 1
    seen = np.zeros(lanes, np.int64)

    def shift(at: np.ndarray) -> None:
        now, to = low.take(at), place.take(at)
        words[to] = now >> _U44
        low[at] = (now & _LOW44) << _U16
        place[at] = to + 1

    for some in columns:
        second, first = model.predict(seen)
        hit2, hit1 = some == model.p2, some == model.p1
        missed = ~(hit1 | hit2)
        octaves = of.take(some) * missed
        inner = (some - firsts.take(some)) * missed
        both = second + first
        rest = (1 << 16) - both
        begin = np.where(missed, both + (rest * begins.take(some) >> 16), second * ~hit2)
        size = np.where(missed, both + (rest * ends.take(some) >> 16), np.where(hit2, second, both)) - begin
        unit = span >> _U16
        low += unit * begin.view(np.uint64)
        span = unit * size.view(np.uint64) >> octaves.view(np.uint64)
        low += span * inner.view(np.uint64)
        at = np.flatnonzero(span <= _TOP)
        while len(at):
            shift(at)
            now = span.take(at) << _U16
            span[at] = now
            at = at[now <= _TOP]
        model.update(some, hit1, hit2)
        seen = some
    every = np.arange(lanes)
    for _ in range(4):
        shift(every)
    sizes = place - begin_of
    kept = words.reshape(lanes, width)[:, : int(sizes.max())]
    while (over := kept >> np.uint32(16)).any():
        kept = kept & np.uint32(0xFFFF)
        kept[:, :-1] += over[:, 1:]
    packed = kept.astype("<u2")
    return [packed[i, : sizes[i]].tobytes() for i in range(lanes)]


def decode(blocks: list[bytes], length: int, counts: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int32), *[_decode(blocks[a : a + LANES], length, counts) for a in range(0, len(blocks), LANES)]])


def _decode(blocks: list[bytes], length: int, counts: np.ndarray) -> np.ndarray:
    lanes = len(blocks)
    model = _Model(lanes, counts)
    words = np.zeros((lanes, max(len(b) for b in blocks) // 2 + 6), np.uint16)
    for i, b in enumerate(blocks):
        words[i, : len(b) // 2] = np.frombuffer(b, "<u2")
    code = words[:, 0].astype(np.uint64) << _U44 | words[:, 1].astype(np.uint64) << np.uint64(28) | words[:, 2].astype(np.uint64) << np.uint64(12) | words[:, 3].astype(np.uint64) >> np.uint64(4)
    next_ = ((words[:, 3:-1] & np.uint16(15)) << np.uint16(12) | words[:, 4:] >> np.uint16(4)).astype(np.uint64)  # 60 bits are held at once
    flat, place = next_.reshape(-1), np.arange(lanes, dtype=np.int64) * next_.shape[1]
    span = np.full(lanes, _SPAN, np.uint64)
    out, seen = np.empty((length, lanes), np.int32), np.zeros(lanes, np.int64)
    holds = np.searchsorted(model.bounds[1:-1], np.arange((1 << 16) + 1), "right")  # the octave of each place in 2^16
    for t in range(length):
        second, first = model.predict(seen)
        both = second + first
        rest = (1 << 16) - both
        unit = span >> _U16
        value = np.minimum(code // unit, np.uint64(65535)).view(np.int64)
        right2, missed = value < second, value >= both
        # bounds b with both + (rest * b >> 16) <= value are passed; the quotient is exact below 2^33
        passed = (((value - both + 1 << 16) - 1) / rest).astype(np.int64)
        found = holds.take(passed, mode="clip")
        octaves = found * missed
        begin = np.where(missed, both + (rest * model.bounds.take(found) >> 16), second * ~right2)
        size = np.where(missed, both + (rest * model.bounds.take(found + 1) >> 16), np.where(right2, second, both)) - begin
        code -= unit * begin.view(np.uint64)
        span = unit * size.view(np.uint64) >> octaves.view(np.uint64)
        inner = np.minimum((code // span).view(np.int64), (1 << octaves) - 1)
        code -= span * inner.view(np.uint64)
        at = np.flatnonzero(span <= _TOP)  # a damaged lane may read on in others; checksums tell
        while len(at):
            from_at = place.take(at)
            code[at] = code.take(at) << _U16 | flat.take(from_at, mode="clip")
            place[at] = from_at + 1
            now = span.take(at) << _U16
            span[at] = now
            at = at[now <= _TOP]
        some = np.where(missed, (1 << octaves) - 1 + inner, np.where(right2, model.p2, model.p1))
        out[t] = some
        model.update(some, some == model.p1, some == model.p2)
        seen = some
    return out.T.reshape(-1)
