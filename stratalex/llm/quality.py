"""Quality by nearest-neighbour voting in a latent-semantic space.

A text's terms are its byte pairs (hashed to a fixed number of places) and bins of a few statistics of the whole
text. A bounded sample of labelled rows gives term weights, the leading singular vectors and the labelled vectors.
These are broadcast; their size is fixed by SAMPLE, PLACES and RANK whatever the input. Every document's cosine to
every labelled vector is computed exactly, in blocks, and its NEIGHBOURS nearest vote with weights that grow with
similarity. Labels, language, source and doc_id are never terms.

Defined cases: a null text counts as empty; an empty text has the terms of an empty text and a score like any other;
no usable label gives every document the score 0.5; a null label or null doc_id is not learned from; several labels
of a document count each; very long texts are read whole, in blocks; other columns pass through, except those named
like an output.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import pick, with_columns

#: Labelled rows learned from at most, those least by a hash of doc_id.
SAMPLE = 4096
PLACES, RANK, NEIGHBOURS, SHARPNESS = 1024, 48, 25, 8
BINS = 8
#: Weight of a statistic against the unit-length byte pairs.
STATISTICS = 2.0
BLOCK = 1 << 20

_PAIRS = ((np.arange(1 << 16, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(54)).astype(np.int16)
_UPPER, _DIGIT, _MARK, _SPACE = (np.isin(np.arange(256), list(c)) for c in (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>!@^~_=+{}[]\\", b" \t\n\r\x0b\x0c"))
#: Statistics and the range over which each is binned.
_RANGES = np.array([(0, 9), (0, 1), (2, 10), (0, 1), (0, 0.3), (0, 0.3), (0, 0.5), (0, 1), (0, 1)])
TERMS = PLACES + len(_RANGES) * BINS


def terms(text: str | None) -> np.ndarray:
    """Raw term weights of a whole text."""
    raw = (text or "").encode()
    out = np.zeros(TERMS, dtype=np.float32)
    counts, bytes_ = np.zeros(PLACES, dtype=np.int64), np.zeros(256, dtype=np.int64)
    for k in range(0, len(raw), BLOCK):
        block = np.frombuffer(raw, dtype=np.uint8, count=min(BLOCK + 1, len(raw) - k), offset=k)
        counts += np.bincount(_PAIRS[block[:-1].astype(np.uint16) << 8 | block[1:]], minlength=PLACES)
        bytes_ += np.bincount(block[:BLOCK], minlength=256)
    weight = np.log1p(counts)
    norm = np.sqrt((weight**2).sum())
    out[:PLACES] = weight / norm if norm else 0
    words, n = raw.split(), max(1, len(raw))
    count, kinds = max(1, len(words)), {}
    for w in words:
        kinds[w] = kinds.get(w, 0) + 1
    lines = [x for x in raw.split(b"\n") if x.strip()]
    solid = n - bytes_[_SPACE].sum()
    values = (np.log1p(len(words)), len(kinds) / count, solid / count, bytes_[_UPPER].sum() / n, bytes_[_DIGIT].sum() / n, bytes_[_MARK].sum() / n, max(kinds.values(), default=0) / count, 1 - len(set(lines)) / max(1, len(lines)), min(1.0, len(lines) / count))
    low, high = _RANGES.T
    place = np.clip((np.array(values) - low) / (high - low), 0, 1) * (BINS - 1)
    left = np.minimum(place.astype(int), BINS - 2)
    part = (place - left).astype(np.float32)
    at = PLACES + np.arange(len(values)) * BINS + left
    out[at] += (1 - part) * STATISTICS
    out[at + 1] += part * STATISTICS
    return out


class Model:
    """Term weights, singular vectors, labelled vectors and their labels; all of bounded size."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray):
        self.prior = float(labels.mean()) if len(labels) else 0.5
        if not len(labels):
            self.project = self.vectors = None
            return
        rows = rows.astype(np.float32)
        weight = np.log((1 + len(rows)) / (1 + (rows > 0).sum(axis=0))) + 1
        weight[PLACES:] = 1
        weighted = rows * weight.astype(np.float32)
        values, vectors = np.linalg.eigh((weighted.T @ weighted).astype(np.float64))
        self.project = (weight[:, None] * vectors[:, np.argsort(values)[::-1][:RANK]]).astype(np.float32)
        self.vectors, self.labels = _unit(rows @ self.project), labels.astype(np.float32)

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.vectors is None:
            return np.full(len(rows), self.prior)
        near = _unit(rows @ self.project) @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        at = np.argpartition(near, near.shape[1] - k, axis=1)[:, -k:]
        weight = np.clip(np.take_along_axis(near, at, axis=1), 0, 1).astype(np.float64) ** SHARPNESS
        return np.clip((weight * self.labels[at]).sum(axis=1) + self.prior * 1e-3, 0, None) / (weight.sum(axis=1) + 1e-3)


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.sqrt((rows**2).sum(axis=1, keepdims=True))
    return rows / np.where(norm > 0, norm, 1)


def held_out(doc_id: Column) -> Column:
    """crc32 of doc_id as text is a multiple of five; a null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model:
    """Learns from at most `sample` labelled rows that are not held out."""
    order = [F.xxhash64("doc_id"), "doc_id", "label"]
    usable = pick(labels, doc_id="doc_id", label=label).where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.orderBy(*order).limit(sample)
    texts = pick(documents, doc_id="doc_id", text="text").join(F.broadcast(usable), "doc_id")  # at most `sample` keys
    made = with_columns(texts, ["text"], lambda some: [[terms(t).astype(np.float16).tobytes() for t in some]], pa.schema([("terms", pa.binary())]), ["doc_id", "label"])
    rows = made.orderBy(*order, "terms").limit(sample).collect()
    found = np.frombuffer(b"".join(r["terms"] for r in rows), dtype=np.float16).reshape(-1, TERMS)
    return Model(found, np.array([float(r["label"] > 0) for r in rows]))


def score(documents: DataFrame, model: Model, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Adds score (double, 0 to 1, higher for label 1)."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return with_columns(documents, [text], lambda texts: [np.clip(shared.value.score(np.stack([terms(t) for t in texts])), 0, 1).tolist()], pa.schema([("score", pa.float64())]), carry)
