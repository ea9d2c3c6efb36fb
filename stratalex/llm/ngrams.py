"""Stupid-backoff language-model scores, computed relationally.

N-grams of one to `order` words are counted over all documents. A document is scored by the counts of all others: c is
an n-gram's count without the document's own. A word's score takes the longest n-gram that ends with it and is counted
`least` times or more, and pays `backoff` for each shorter step:

  S = backoff ** steps * c(n-gram) / c(n-gram without its last word);  for one word: max(c(word), 1) / words of the others

A document's score is the sum of log S over its words. The relations:

1. chunks: documents are cut into words; a chunk of about `chunk_words` words holds them as places in its own sorted
   vocabulary of 64-bit hashes. Chunks are written once, so that later steps see the same ones.
2. occurrences (key, chunk, own): a row for each distinct n-gram of a chunk with its count there, so that no n-gram is
   hot: it has a row a chunk at most. An n-gram of three words or more is a row only if both n-grams of one word less
   in it are counted in other documents; otherwise it cannot be.
3. counts (key, total): occurrences summed by key, partitioned by its hash.
4. told (chunk, part, elsewhere): occurrences joined to counts on the key; for each occurrence, how often other chunks have
   the n-gram. Those of a chunk in one part of the hash are packed in the order of their keys, without the keys: the
   chunk has them. A pack holds a row or more, so packs are never more than rows.
5. scores: each chunk meets what it is told, shuffled on the chunk, and sums by document.

Everything grows with the n-grams of the corpus and nothing with a square. An n-gram is told by a 64-bit hash: among
10^13 distinct ones a given n-gram shares its hash with another with a probability of 5e-7.

Defined cases: a null, empty or blank text has no words, score 0 and a null mean; equal rows are documents of their own and
give equal rows each; null ids are kept; an empty table gives an empty result; the words of a table with one document
count 1 each; very long texts count whole, in one chunk; other columns are left aside.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import BATCH_BYTES, bound_batches, cut, pick, slices

ORDER, BACKOFF, LEAST = 3, 0.4, 1
CHUNK_WORDS = 3 << 19
#: Rows of an Arrow batch of occurrences.
ROWS = 1 << 16
#: Told rows that are packed together where keys go along.
PACK = 1 << 20
#: Words of the corpus for each part of the hash at most; a part has two occurrences a word at most.
PART_WORDS = 1 << 20
_A, _B, _S = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(29)
#: Settings while rows of the first exchange are told: the files of its shuffle go when it ends, and Arrow batches are bounded
#: by rows alone, for Spark would measure the batch before each row, at 0.6 microseconds.
TELLING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", BATCH_BYTES: str((1 << 31) - 1)}

CHUNK = "chunk long, n_words long, doc_ids array<long>, sizes binary, vocabulary binary, words binary"
OCCURRENCE = "key long, chunk long, own int"
PACKED = "chunk long, part int, elsewhere binary"
SCORE = "doc_id long, n_words long, n_backoff long, log_score double"


def planes(values: np.ndarray) -> bytes:
    """Bytes of the values, the first of each, then the second and so on, so that like bytes lie together; compressed."""
    if not len(values):
        return b""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes())


def from_planes(raw: bytes, kind: type) -> np.ndarray:
    if not raw:
        return np.zeros(0, kind)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(width, -1).T).view(kind).reshape(-1)


def pack_keys(ordered: np.ndarray) -> bytes:
    return planes(np.diff(ordered, prepend=np.uint64(0)))


def unpack_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(from_planes(raw, np.uint64), dtype=np.uint64)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The partition of each key among `parts`, as Spark deals a long: Murmur3 of seed 42, modulo."""

    def mixed(k: np.ndarray) -> np.ndarray:
        k = k * np.uint32(0xCC9E2D51)
        return (k << np.uint32(15) | k >> np.uint32(17)) * np.uint32(0x1B873593)

    h = np.uint32(42)
    for half in (keys.astype(np.uint32), (keys >> np.uint64(32)).astype(np.uint32)):
        h = h ^ mixed(half)
        h = (h << np.uint32(13) | h >> np.uint32(19)) * np.uint32(5) + np.uint32(0xE6546B64)
    h ^= np.uint32(8)
    h = (h ^ h >> np.uint32(16)) * np.uint32(0x85EBCA6B)
    h = (h ^ h >> np.uint32(13)) * np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(16)
    return (h.view(np.int32) % np.int32(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int32)


def _chunks(chunk_words: int):
    def run(batches):
        return _cut_chunks(batches, chunk_words)

    return run


def _cut_chunks(batches, chunk_words: int):
    number, words, ids, sizes = TaskContext.get().partitionId() << 32, [], [], []

    def close():
        coded = pa.chunked_array(words, pa.binary()).combine_chunks().dictionary_encode()
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], dtype=np.uint64)
        order = np.argsort(hashes)
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        every = np.concatenate(sizes)
        row = [[number], [len(coded)], [[i for some in ids for i in some]], [every.astype(np.uint32).tobytes()], [pack_keys(hashes[order])], [planes(rank[np.asarray(coded.indices)])]]
        types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=["chunk", "n_words", "doc_ids", "sizes", "vocabulary", "words"])

    held = 0
    for batch in batches:
        for part in slices(batch):
            found, counts = _words(part.column(1))
            ends = np.cumsum(counts)
            first = done = 0
            while first < len(counts):  # a chunk ends with the document that fills it
                last = min(int(np.searchsorted(ends, done + chunk_words - held)) + 1, len(counts))
                upto = int(ends[last - 1])
                words.append(found.slice(done, upto - done))
                ids.append(part.column(0).slice(first, last - first).to_pylist())
                sizes.append(counts[first:last])
                held += upto - done
                first, done = last, upto
                if held >= chunk_words:
                    yield close()
                    number, words, ids, sizes, held = number + 1, [], [], [], 0
    if ids:
        yield close()


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, with A-Z in lower case, and how many each text has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    found, of = split.flatten(), np.asarray(pc.list_parent_indices(split))
    some = pc.greater(pc.binary_length(found), 0)  # around white space at either end
    counts = np.bincount(of[np.asarray(some)], minlength=len(texts))
    return found.filter(some).cast(pa.binary()), counts


class _Grams(NamedTuple):
    """Distinct n-grams of a chunk, in the order of their keys, and the places where their last words may be."""

    keys: np.ndarray
    own: np.ndarray  # counts here
    ends: np.ndarray
    at: np.ndarray  # for each of ends, which n-gram ends there


class _Chunk:
    """N-grams of a chunk, level by level: distinct(n) must follow distinct(n - 1), and for n > 2 met_of() of that."""

    def __init__(self, sizes: bytes, vocabulary: bytes, words: bytes, told: pa.Table | None = None, parts: int = 1, least: int = 1):
        self.sizes, self.parts, self.least = np.frombuffer(sizes, np.uint32).astype(np.int64), parts, least
        self.vocabulary, self.words = unpack_keys(vocabulary), from_planes(words, np.uint32)
        self.hashes = self.vocabulary[self.words]
        self.document = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.place = np.arange(len(self.hashes)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)  # of a word in its document
        self.told: dict[int, dict[int, bytes]] = {}
        if told is not None:
            for longest, part, elsewhere in zip(*(told.column(c).to_pylist() for c in ("longest", "part", "elsewhere"))):
                if part in (packs := self.told.setdefault(longest, {})):
                    raise ValueError(f"part {part} was told in pieces")
                packs[part] = elsewhere

    def distinct(self, n: int) -> _Grams:
        if n == 1:
            self.grams = self.hashes
            return _Grams(self.vocabulary, np.bincount(self.words, minlength=len(self.vocabulary)), np.arange(len(self.words)), self.words.astype(np.int64))
        grams = np.zeros_like(self.grams)
        grams[1:] = self.grams[:-1] * _A + self.hashes[1:] * _B
        self.grams = grams ^ grams >> _S
        may = self.place >= n - 1
        if n > 2:  # those that may be counted elsewhere
            may[1:] &= (self.met[1:] >= self.least) & (self.met[:-1] >= self.least)
        ends = np.flatnonzero(may)
        keys, at, own = np.unique(self.grams[ends], return_inverse=True, return_counts=True)
        return _Grams(keys, own, ends, at)

    def elsewhere(self, longest: int, keys: np.ndarray) -> np.ndarray:
        """How often other chunks have each n-gram: packs lie in the order of parts and keys."""
        order = np.argsort(keys)
        part = part_of(keys[order], self.parts)
        order = order[np.argsort(part, kind="stable")]
        packs = self.told.get(longest, {})
        values = {p: from_planes(packs[p], np.int64) for p in sorted(packs)}
        sizes = np.bincount(part)
        if {p: len(v) for p, v in values.items()} != {p: n for p, n in enumerate(sizes.tolist()) if n}:
            raise ValueError("a chunk was not told of all its n-grams")
        out = np.zeros(len(keys), np.int64)
        out[order] = np.concatenate([np.zeros(0, np.int64), *values.values()])
        return out

    def met_of(self, grams: _Grams, elsewhere: np.ndarray) -> np.ndarray:
        """For each place, the count of the n-gram that ends there in all other documents."""
        mine = np.ones(len(grams.ends), np.int64)  # in the document itself
        again = np.flatnonzero(grams.own[grams.at] > 1)
        _, at, counts = np.unique(grams.at[again] * len(self.sizes) + self.document[grams.ends[again]], return_inverse=True, return_counts=True)
        mine[again] = counts[at]
        self.met = np.zeros(len(self.hashes), np.int64)
        self.met[grams.ends] = (grams.own + elsewhere)[grams.at] - mine
        return self.met

    def met_to(self, last: int) -> Iterator[np.ndarray]:
        """met_of() of n-grams of 1 to `last` words."""
        first = [self.distinct(n) for n in range(1, min(last, 2) + 1)]
        elsewhere = self.elsewhere(2, np.concatenate([g.keys for g in first]))
        for g in first:
            yield self.met_of(g, elsewhere[: len(g.keys)])
            elsewhere = elsewhere[len(g.keys) :]
        for n in range(3, last + 1):
            grams = self.distinct(n)
            yield self.met_of(grams, self.elsewhere(n, grams.keys))


def _rows(grams: _Grams, number: int):
    for k in range(0, len(grams.keys), ROWS):
        keys, own = grams.keys[k : k + ROWS].view(np.int64), grams.own[k : k + ROWS].astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(len(keys), number)), pa.array(own)], names=["key", "chunk", "own"])


def _occurrences(order: int):
    """N-grams of one and two words."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                number, *stored = (batch.column(c)[k].as_py() for c in range(4))
                chunk = _Chunk(*stored)
                for n in range(1, min(order, 2) + 1):
                    yield from _rows(chunk.distinct(n), number)

    return run


def _longer(n: int, least: int, parts: int):
    """N-grams of n words, of which those of n - 1 words are counted elsewhere."""

    def run(chunks: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        for k in range(chunks.num_rows):
            chunk = _Chunk(*[chunks.column(c)[k].as_py() for c in ("sizes", "vocabulary", "words")], told, parts, least)
            for _ in chunk.met_to(n - 1):
                pass
            out += _rows(chunk.distinct(n), chunks.column("chunk")[k].as_py())
        return pa.Table.from_batches(out, pa.schema([("key", pa.int64()), ("chunk", pa.int64()), ("own", pa.int32())]))

    return run


def _scores(order: int, least: int, total: int, backoff: float, parts: int):
    def run(chunks: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        for k in range(chunks.num_rows):
            chunk = _Chunk(*[chunks.column(c)[k].as_py() for c in ("sizes", "vocabulary", "words")], told, parts, least)
            others = np.maximum(total - chunk.sizes, 1)
            before = longest = None
            for n, met in enumerate(chunk.met_to(order), 1):
                if n == 1:
                    score = np.log(np.maximum(met, 1) / others[chunk.document])
                    longest = np.ones(len(score), np.int64)
                else:
                    found = np.flatnonzero(met >= least)
                    score[found] = np.log(met[found] / before[found - 1])
                    longest[found] = n
                before = met
            steps = np.minimum(chunk.place + 1, order) - longest
            score += steps * np.log(backoff)
            size = len(chunk.sizes)
            backed, summed = np.bincount(chunk.document[steps > 0], minlength=size), np.bincount(chunk.document, weights=score, minlength=size)
            out.append(pa.table({"doc_id": pa.array(chunks.column("doc_ids")[k].as_py(), pa.int64()), "n_words": pa.array(chunk.sizes), "n_backoff": pa.array(backed.astype(np.int64)), "log_score": pa.array(summed.astype(np.float64))}))
        return pa.concat_tables(out)

    return run


def _told(occurrences: DataFrame, parts: int) -> DataFrame:
    """occurrences joined to their counts, both partitioned by the hash of the key: how often other chunks have the n-gram.
    Both sides read the same columns, so that they share one exchange; a partition's counts are bounded by PART_WORDS."""
    parted = occurrences.where("key is not null and own is not null").repartition(parts, "key")
    counts = parted.groupBy("key").agg(F.sum("own").alias("total"), F.count("chunk").alias("chunks")).where("chunks > 1")
    counts = counts.select(F.col("key").alias("counted"), "total").hint("shuffle_hash")
    joined = parted.join(counts, F.col("key") == F.col("counted"), "left")
    return joined.select("chunk", "key", F.coalesce(F.col("total") - F.col("own"), F.lit(0)).alias("total"))


def _pack(batches, parts: int = 0):
    """told rows, packed by chunk for the way back, never more than told has: keys ascending, and their totals. With
    `parts`, a partition's rows are packed whole, by chunk and part, and the keys stay behind."""

    def close(held: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(held)
        chunk, key, total = np.asarray(rows.column("chunk")), np.asarray(rows.column("key")).view(np.uint64), np.asarray(rows.column("total"))
        part = part_of(key, parts) if parts else np.zeros(len(key), np.uint16)
        order = np.argsort(chunk, kind="stable")  # rows of a chunk come in the order of keys, as a rule
        if part.any() and (part != part[0]).any() or ((chunk[order[1:]] == chunk[order[:-1]]) & (key[order[1:]] < key[order[:-1]])).any():
            order = np.lexsort((key, part, chunk))
        chunk, key, part, total = chunk[order], key[order], part[order], total[order]
        first = np.flatnonzero(np.concatenate([[True], (chunk[1:] != chunk[:-1]) | (part[1:] != part[:-1])]))
        spans = list(zip(first.tolist(), [*first[1:].tolist(), len(chunk)]))
        totals = pa.array([planes(total[a:b]) for a, b in spans], pa.binary())
        if parts:
            return pa.RecordBatch.from_arrays([pa.array(chunk[first]), pa.array(part[first].astype(np.int32)), totals], names=["chunk", "part", "elsewhere"])
        return pa.RecordBatch.from_arrays([pa.array(chunk[first]), pa.array([pack_keys(key[a:b]) for a, b in spans], pa.binary()), totals], names=["chunk", "keys", "totals"])

    held = []
    for batch in batches:
        held.append(batch)
        if not parts and sum(b.num_rows for b in held) >= PACK:
            yield close(held)
            held = []
    if held and any(b.num_rows for b in held):
        yield close(held)


def _packed(told: DataFrame, parts: int) -> DataFrame:
    return told.mapInArrow(lambda batches: _pack(batches, parts), PACKED)


def score(df: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER, least: int = LEAST, backoff: float = BACKOFF, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """doc_id, n_words, n_backoff (words scored by backing off), log_score and mean_log (log_score by n_words)."""
    spark = df.sparkSession
    bound_batches(spark)
    chunks = cut(pick(df, doc_id=doc_id, text=text).mapInArrow(_chunks(chunk_words), CHUNK), "chunks")
    total = int(chunks.agg(F.sum("n_words")).first()[0] or 0)
    dealt = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(dealt, -(-total // PART_WORDS))
    stored = chunks.drop("n_words")  # all levels share one exchange of these
    told = _packed(_told(chunks.select("chunk", "sizes", "vocabulary", "words").mapInArrow(_occurrences(order), OCCURRENCE), parts), parts)
    # written, and the files of its exchange freed; then dealt once for all levels: a union of tables dealt alike stays dealt
    before = {k: spark.conf.get(k) for k in TELLING}
    try:
        for k, v in TELLING.items():
            spark.conf.set(k, v)
        told = cut(told, "told")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)

    def to_chunks(packed: DataFrame, longest: int) -> DataFrame:
        return packed.select("chunk", F.lit(longest).alias("longest"), "part", "elsewhere").repartition(dealt, "chunk")

    told = to_chunks(told, 2)
    for n in range(3, order + 1):
        longer = stored.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(_longer(n, least, parts), OCCURRENCE)
        told = told.unionAll(to_chunks(_packed(_told(longer, parts), parts), n))
    scored = stored.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(_scores(order, least, total, backoff, parts), SCORE)
    return scored.withColumn("mean_log", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))
