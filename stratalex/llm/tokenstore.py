"""Token-ID files: texts become ids, ids become segments of range-coded, checksummed blocks, and segments are read back.

A folder holds Parquet rows (shard, segment, before, n_docs, n_ids, payload). A payload is one segment in this
library's own binary format and can be read by itself:

  magic "SLT2"; format, block length, documents, blocks, distinct ids: uint32; ids: uint64; crc32 of what follows up to the blocks
  doc_id int64 and a null flag byte for each document; ids uint32 for each document
  coded bytes uint32 and crc32 of the block's ids (uint32 each) for each block; how many ids fall into each of 24 octaves
  of ranks: uint32; the distinct ids uint32, most frequent first (an id's place is the rank that is coded); then the coded blocks

All integers are little-endian. Segments hold whole documents, in ascending doc_id order over the folder (nulls
first, then by text for equal ids); `before` is the ids of the same shard before the segment. Spark's writer commits
the folder, so a lost executor leaves no half-written file behind. Blocks shorten with the segment, so that a small one
still has many to advance together; the length is in the header.

Texts are encoded by the tokenizers library with add_special_tokens=False. Where its file says byte-level BPE with the usual
split and nothing else, a text is cut at each single space or newline between two other characters, where no pre-token can
reach across, and the ids of recent parts are remembered; a text that holds an added token goes to the library whole.

Defined cases: a null text counts as empty and has the end id alone; equal rows are stored each, in either order; an empty table
makes an empty folder; a text of any length stays in one segment, whose blocks keep their length; other columns are left
aside. A damaged header or block raises ValueError.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import rangecoder
from .base import SLICE_BYTES, bound_batches, pick

MAGIC, FORMAT, END_ID = b"SLT2", 3, 0
#: Ids after which a segment is closed.
SEGMENT = rangecoder.LANES * rangecoder.BLOCK
_HEAD = struct.Struct("<4sIIIIIQI")
#: Parts remembered in each of two generations, and their longest; the older generation goes when the younger is full.
GENERATION, REMEMBERED_CHARS = 3 << 18, 48
#: White space but space and newline, and what some readings count as such.
_RARE = "[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]"
#: Texts with white space that is rare, doubled or at an end.
SPACED = "\\A | \\z|  | \n|\n |\n\n|" + _RARE
#: A single space between two characters that are no white space in any reading.
SPACE = re.compile("(?<=[^\\s\x1c-\x1f\u180e\u200b\ufeff]) (?=[^\\s\x1c-\x1f\u180e\u200b\ufeff])")
#: Parts whose pre-tokens are plain: a newline, letters, marks.
PLAIN = re.compile("([\n\r]?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)").fullmatch
#: Parts that are a single pre-token of letters.
WORD = re.compile("\r?[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
#: Where a letter's pre-token ends for certain: at ASCII marks but the apostrophe.
MARKED = "([A-Za-zÀ-ÖØ-öø-ÿ])([!-&(-/:-@\\[-`{-~])"
#: Bytes of rows that are encoded in one pass.
PASS_BYTES = 8 << 20


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if visible, else from U+0100 on in order."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


SCHEMA = "shard int, segment int, before long, n_docs long, n_ids long, payload binary"


class Encoder:
    """Ids of whole texts by a tokenizers file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        split = parts.get("pre_tokenizer") or {}
        plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        self.by_parts = plain and parts["model"]["type"] == "BPE" and not parts.get("normalizer") and not parts.get("truncation") and not parts.get("padding")
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.hidden = {chr(b): x for b, x in self.letters.items() if chr(b) != x}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _coded(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of single pre-tokens without newlines by the library's model, piece by piece: a call for many takes twice as long."""
        joined, model = "\n".join(pieces).encode().decode("latin-1"), self.library.model.tokenize
        for byte, letter in self.hidden.items():
            if byte in joined:
                joined = joined.replace(byte, letter)
        return [array("I", [t.id for t in model(p)]).tobytes() for p in joined.split(self.letters[10])]

    def _learn(self, keys: set[str]) -> None:
        """Remembers the ids of parts."""
        words = [k for k in keys if WORD(k)]
        if words:
            self.young.update(zip(words, self._pieces([_said(k) for k in words])))
        joined, pieces, others = {}, set(), []
        for k in keys.difference(words):
            if plain := PLAIN(k):
                mark, word, after = plain.groups()
                if not mark and not after:
                    pieces.add(k)
                    continue
                parts = ["\n"] if mark == "\n" else []
                parts.append("\r" + word if mark else word)
                if after:
                    parts.append("\r" + after)
                pieces.update(parts)
                if len(parts) > 1:
                    joined[k] = parts
            else:
                others.append(k)
        if "\n" in pieces:
            others.append("\n")
        pieces = pieces.difference(self.young, ["\n"])
        again = self.old.keys() & pieces
        self.young.update((p, self.old[p]) for p in again)
        new = list(pieces.difference(again))
        if new:
            self.young.update(zip(new, self._pieces([_said(p) for p in new])))
        self.young.update(zip(others, self._coded([_said(k) for k in others])))
        for k, parts in joined.items():
            self.young[k] = b"".join([self.young[p] for p in parts])

    def _known(self, parts: list[str]) -> list[bytes]:
        """Ids of each part."""
        needed = set(parts).difference(self.young)
        if needed:
            if len(self.young) > GENERATION:
                self.old, self.young = self.young, {}
                needed = set(parts)
            again = self.old.keys() & needed
            self.young.update((p, self.old[p]) for p in again)
            self._learn(needed.difference(again))
        made = list(map(self.young.__getitem__, parts))
        for p in needed:
            if len(p) > REMEMBERED_CHARS:
                del self.young[p]
        return made

    def _simple(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """coded() of texts with single spaces and newlines inside alone, in columns."""
        texts = pc.replace_substring(pc.binary_join_element_wise("\r", texts, ""), "\n", " \n \r")
        split = pc.split_pattern(pc.replace_substring_regex(texts, MARKED, "\\1 \r\\2"), " ")
        parts = split.flatten().dictionary_encode()
        known = self._known(parts.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids, sizes = np.frombuffer(b"".join(known), np.uint32), np.fromiter(map(len, known), np.int64, len(known)) >> 2
        begins, at = np.cumsum(sizes) - sizes, np.asarray(parts.indices)
        size = sizes.take(at)
        ends = np.cumsum(size)
        ids = ids.take(np.repeat(begins.take(at) - ends + size, size) + np.arange(int(ends[-1])))
        last = ends[np.cumsum(np.asarray(pc.list_value_length(split))) - 1]
        return np.insert(ids, last, END_ID), np.diff(last, prepend=0) + 1

    def coded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, unsigned 32-bit integers with the end id after each text, and how many each text has."""
        texts = pc.fill_null(texts, "")
        other = pc.or_(pc.equal(texts, ""), pc.match_substring_regex(texts, SPACED)) if self.by_parts else pa.array([True] * len(texts))
        for added in self.added:
            other = pc.or_(other, pc.match_substring(texts, added))
        other = np.asarray(other.cast(pa.uint8())).view(bool)
        if len(texts) and not other.any():
            return self._simple(texts)
        rare = texts.filter(pa.array(other)).to_pylist()
        whole = [t for t in rare if t and (not self.by_parts or any(a in t for a in self.added))]
        made = dict(zip(whole, self._coded(whole)))
        end = array("I", [END_ID]).tobytes()
        raw = [made[t] if t in made else b"".join(self._known(parts_of(t))) if t else b"" for t in rare]
        counts, ids = np.zeros(len(texts), np.int64), [np.frombuffer(r + end, np.uint32) for r in raw]
        counts[other] = [len(x) for x in ids]
        if len(rare) < len(texts):
            simple, counts[~other] = self._simple(texts.filter(pa.array(~other)))
            split = iter(np.split(simple, np.cumsum(counts[~other])[:-1]))
            rest = iter(ids)
            ids = [next(rest if o else split) for o in other.tolist()]
        return np.concatenate([np.zeros(0, np.uint32), *ids]), counts

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as unsigned 32-bit integers, with the end id."""
        ids, counts = self.coded(pa.array(texts, pa.string()))
        return [x.tobytes() for x in np.split(ids, np.cumsum(counts)[:-1])] if texts else []


def parts_of(text: str) -> list[str]:
    """A text as parts that no pre-token crosses: "\r" and the first, or one after a space, without it. Encoder._simple has more
    of them: a newline, "\r" and what follows it, and "\r" and marks after a letter."""
    parts = SPACE.split(text)
    parts[0] = "\r" + parts[0]
    return parts


def _said(part: str) -> str:
    return part[1:] if part[0] == "\r" else part if part[0] == "\n" else " " + part


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pack(doc_ids: list[int | None], texts: list[bytes]) -> bytes:
    """One segment from documents' ids, unsigned 32-bit integers."""
    return pack_ids(doc_ids, np.array([len(t) // 4 for t in texts], "<u4"), np.frombuffer(b"".join(texts), np.uint32))


def pack_ids(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    """One segment: counts of ids of the documents, and all ids in order."""
    length = rangecoder.block_length(len(ids))
    found, place = _distinct(ids)
    ranks = place.take(ids) if len(found) else np.zeros(0, np.int32)
    octaves = rangecoder.octave_counts(ranks)
    blocks = rangecoder.encode(ranks, length, octaves)
    sums = [zlib.crc32(ids[k : k + length].astype("<u4")) for k in range(0, len(ids), length)]
    table = b"".join([
        np.array([i or 0 for i in doc_ids], "<i8").tobytes(),
        bytes(i is None for i in doc_ids),
        counts.astype("<u4").tobytes(),
        np.array([len(b) for b in blocks], "<u4").tobytes(),
        np.array(sums, "<u4").tobytes(),
        np.pad(octaves, (0, rangecoder.OCTAVES - len(octaves))).astype("<u4").tobytes(),
        found.astype("<u4").tobytes(),
    ])
    head = _HEAD.pack(MAGIC, FORMAT, length, len(doc_ids), len(blocks), len(found), len(ids), zlib.crc32(table))
    return head + table + b"".join(blocks)


def _distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids, most frequent first, and the rank of each id up to the greatest."""
    counts = np.bincount(ids, minlength=1)
    found = np.flatnonzero(counts)
    found = found[np.argsort(-counts[found], kind="stable")]
    place = np.zeros(len(counts), np.int32)
    place[found] = np.arange(len(found), dtype=np.int32)
    return found, place


def unpack(payload: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, ids of each document (counts), all ids in order."""
    magic, kind, length, documents, blocks, distinct, total, check = _HEAD.unpack_from(payload)
    if magic != MAGIC or kind != FORMAT:
        raise ValueError("not a segment of this format")
    at = _HEAD.size
    size = documents * 13 + blocks * 8 + (rangecoder.OCTAVES + distinct) * 4
    if zlib.crc32(payload[at : at + size]) != check:
        raise ValueError("the segment's tables are damaged")
    take = lambda kind, n, after: np.frombuffer(payload, kind, n, at + after)
    doc_ids, nulls, counts = take("<i8", documents, 0), take(np.uint8, documents, 8 * documents), take("<u4", documents, 9 * documents)
    sizes, sums = take("<u4", blocks, 13 * documents), take("<u4", blocks, 13 * documents + 4 * blocks)
    octaves, found = take("<u4", rangecoder.OCTAVES, 13 * documents + 8 * blocks), take("<u4", distinct, 13 * documents + 8 * blocks + 4 * rangecoder.OCTAVES)
    ends = at + size + np.cumsum(sizes.astype(np.int64))
    coded = [payload[e - s : e] for e, s in zip(ends.tolist(), sizes.tolist())]
    ranks = rangecoder.decode(coded, length, octaves[: int(np.flatnonzero(octaves).max(initial=0)) + 1])[:total]
    ids = found.take(ranks, mode="clip") if len(ranks) else np.zeros(0, "<u4")
    for k, want in enumerate(sums.tolist()):
        if zlib.crc32(ids[k * length : (k + 1) * length]) != want:
            raise ValueError(f"block {k} is damaged")
    return [None if none else i for i, none in zip(doc_ids.tolist(), nulls.tolist())], counts, ids


def write(documents: DataFrame, path: str, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """Writes the ids of every document to `path`. Equal doc_ids are dealt out by their texts, so none makes a partition hot."""
    bound_batches(documents.sparkSession)
    rows = pick(documents, doc_id=doc_id, text=text).withColumn("h", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")

    def run(batches):
        shard, segment, before = TaskContext.get().partitionId(), 0, 0
        held_ids, held_counts, held, size = [], [], [], 0

        def close() -> pa.RecordBatch:
            payload = pack_ids(held_ids, np.concatenate(held_counts), np.concatenate(held))
            row = [[shard], [segment], [before], [len(held_ids)], [size], [payload]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=["shard", "segment", "before", "n_docs", "n_ids", "payload"])

        for batch in batches:
            step = max(1, PASS_BYTES * batch.num_rows // max(1, batch.nbytes))
            for k in range(0, batch.num_rows, step):
                doc_ids, texts = batch.column(0).slice(k, step).to_pylist(), batch.column(1).slice(k, step)
                ids, counts = encoder(vocabulary).coded(texts)
                ends = np.cumsum(counts)
                first = done = 0
                while first < len(counts):  # a segment ends with the document that fills it
                    last = min(int(np.searchsorted(ends, done + SEGMENT - size)) + 1, len(counts))
                    upto = int(ends[last - 1])
                    held_ids += doc_ids[first:last]
                    held_counts.append(counts[first:last])
                    held.append(ids[done:upto])
                    size += upto - done
                    first, done = last, upto
                    if size >= SEGMENT:
                        yield close()
                        segment, before = segment + 1, before + size
                        held_ids, held_counts, held, size = [], [], [], 0
        if held:
            yield close()

    rows.mapInArrow(run, SCHEMA).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and token_ids (binary: little-endian unsigned 32-bit)."""
    stored = spark.read.schema(SCHEMA).parquet(path)
    starts, at = {}, 0  # one entry for each file written
    for shard, size in stored.groupBy("shard").agg(F.sum("n_ids")).orderBy("shard").collect():
        starts[shard], at = at, at + size

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                shard, before, payload = (batch.column(c)[k].as_py() for c in range(3))
                doc_ids, counts, ids = unpack(payload)
                begin = np.cumsum(counts.astype(np.int64)) - counts
                raw, first = memoryview(ids).cast("B"), 0
                while first < len(doc_ids):
                    last = max(first + 1, int(np.searchsorted(begin, begin[first] + SLICE_BYTES // 4)))
                    some = range(first, min(last, len(doc_ids)))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([doc_ids[i] for i in some], pa.int64()),
                            pa.array([starts[shard] + before + int(begin[i]) for i in some], pa.int64()),
                            pa.array([int(counts[i]) for i in some], pa.int64()),
                            pa.array([bytes(raw[4 * int(begin[i]) : 4 * (int(begin[i]) + int(counts[i]))]) for i in some], pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "token_ids"],
                    )
                    first = some[-1] + 1

    return stored.select("shard", "before", "payload").mapInArrow(run, "doc_id long, start long, n_tokens long, token_ids binary")
