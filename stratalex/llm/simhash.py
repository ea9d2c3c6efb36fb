"""SimHash near-duplicates through vantage-point trees.

1. Every whole text gets a 64-bit fingerprint: a bit is set if it is set in over half of the XXH64 values
   (seed 42) of its word shingles, repeats included.
2. Equal fingerprints become one point, so copies cost one row however many there are.
3. A vantage-point tree over a bounded sample of points cuts Hamming space into shards. A point is at home in
   one shard; it visits each later shard that the triangle bound |d(x, v) - radius| cannot rule out, so that of
   two near points one meets the other at home. Shards are searched exactly by a tree of their own.
4. A shard returns a spanning forest of the links it found: at most one edge a point, never all pairs.
5. Edges become components by alternating large-star and small-star steps on tables in the shared folder.

Defined cases: a null, empty or wordless text has the fingerprint zero and links like any other; fewer words than
a shingle make one shingle of all of them; equal rows link to each other; a null doc_id never names a component
unless all of a component's are null; an empty table gives an empty result; other columns are left aside.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import cut, pick, position, with_columns

#: Points of the bounded sample that the tree of shards is built on, and shards at most.
SAMPLE, SHARDS = 1 << 16, 1 << 11
#: Points that a shard should hold, and the fewest shards.
SHARD_POINTS, LEAST_SHARDS = 1 << 15, 16
LEAF = 192
#: Comparisons made at once, and links held before they are folded into the forest.
HELD = 1 << 19
SEED = 42


def fingerprint(text: str | None, words: int = 3) -> int:
    found = text.encode().lower().split() if text else []
    if not found:
        return 0
    line = b" ".join(found)
    if len(found) <= words:
        values = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in found]).tolist()
        digest = xxhash.xxh64_intdigest
        values = [digest(line[a : b - 1], SEED) for a, b in zip([0, *ends], ends[words - 1 :])]
    return _majority(np.array(values, dtype=np.uint64))


_LANES = np.uint64(0x0101010101010101)


def _majority(values: np.ndarray) -> int:
    """Bits set in over half of the values. Bytes serve as counters, 255 values at a time."""
    n = len(values)
    rows = np.zeros((-(-n // 255), 255), dtype=np.uint64)
    rows.reshape(-1)[:n] = values
    out = 0
    for bit in range(8):
        counts = ((rows >> np.uint64(bit)) & _LANES).sum(axis=1, dtype=np.uint64).view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for byte in np.flatnonzero(counts * 2 > n).tolist():
            out |= 1 << (8 * byte + bit)
    return out


def fingerprints(df: DataFrame, text: str = "text", words: int = 3, carry: list[str] | None = None) -> DataFrame:
    """Adds fingerprint (long, the 64 bits)."""
    return with_columns(df, [text], lambda texts: [[_signed(fingerprint(t, words)) for t in texts]], pa.schema([("fingerprint", pa.int64())]), carry)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def majority(values: np.ndarray) -> int:
    """The fingerprint (long) of hash values; zero if there are none."""
    return _signed(_majority(values)) if len(values) else 0


def hamming(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int16)


class Tree:
    """Vantage-point tree: inside(d <= bound) and outside, down to leaves of points or of a given number."""

    __slots__ = ("vantage", "bound", "inside", "outside", "leaf", "points")

    def __init__(self, points: np.ndarray, radius: int, least: int, depth: int = 60):
        self.leaf, self.points = -1, points
        self.vantage = self.inside = self.outside = None
        if len(points) <= least or not depth:
            return
        best = None
        for vantage in points[:: max(1, len(points) // 12)][:12]:
            d = hamming(points[:: max(1, len(points) // 4096)], vantage)
            below = np.cumsum(np.bincount(d, minlength=66)) / len(d)
            for bound in range(64):
                share = below[bound]
                if 0.25 <= share <= 0.75:
                    near = below[min(64, bound + radius)] - (below[bound - radius] if bound >= radius else 0.0)
                    cost = near + abs(share - 0.5) * 0.5
                    if best is None or cost < best[0]:
                        best = (cost, vantage, bound)
        if best is None:
            d = hamming(points, points[0])
            bound = int(np.median(d))
            bound = bound if bound < d.max() else bound - 1
            if bound < d.min():
                return
            best = (0, points[0], bound)
        self.vantage, self.bound, self.points = best[1], int(best[2]), None
        inner = hamming(points, self.vantage) <= self.bound
        if inner.all() or not inner.any():
            self.vantage, self.points = None, points
            return
        self.inside, self.outside = Tree(points[inner], radius, least, depth - 1), Tree(points[~inner], radius, least, depth - 1)

    def number(self, first: int = 0) -> int:
        if self.vantage is None:
            self.leaf = first
            return first + 1
        return self.outside.number(self.inside.number(first))

    def home(self, points: np.ndarray, at: np.ndarray, out: np.ndarray) -> None:
        if self.vantage is None:
            out[at] = self.leaf
        elif len(at):
            inner = hamming(points[at], self.vantage) <= self.bound
            self.inside.home(points, at[inner], out)
            self.outside.home(points, at[~inner], out)

    def reached(self, points: np.ndarray, at: np.ndarray, radius: int):
        """(leaf, places of the points whose ball of the radius reaches it)."""
        if not len(at):
            return
        if self.vantage is None:
            yield self, at
        else:
            d = hamming(points[at], self.vantage)
            yield from self.inside.reached(points, at[d - radius <= self.bound], radius)
            yield from self.outside.reached(points, at[d + radius > self.bound], radius)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least node reachable from each of n nodes."""
    root = np.arange(n)
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root


def links(home: np.ndarray, visitors: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among points at home, and between them and visitors."""
    points = np.concatenate([home, visitors])
    order = np.argsort(home)
    tree, ordered = Tree(home, radius, LEAF), home[order]
    root = np.arange(len(points))
    left, right, held = [], [], 0

    def settle() -> None:
        nonlocal root, held
        if held:
            root = forest(len(points), np.concatenate([np.arange(len(points)), *left]), np.concatenate([root, *right]))
            left.clear(), right.clear()
            held = 0

    for leaf, at in tree.reached(points, np.arange(len(points)), radius):
        own = order[np.searchsorted(ordered, leaf.points)]
        step = max(1, HELD // len(leaf.points))
        for k in range(0, len(at), step):
            some = at[k : k + step]
            q, p = np.nonzero(np.bitwise_count(points[some][:, None] ^ leaf.points[None, :]) <= radius)
            x, y = some[q], own[p]
            keep = root[x] != root[y]  # links inside a known component add nothing
            left.append(x[keep])
            right.append(y[keep])
            held += int(keep.sum())
            if held > HELD:
                settle()
    settle()
    linked = np.flatnonzero(root != np.arange(len(points)))
    return points[linked], points[root[linked]]


def _as_points(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.asarray(column, dtype=np.int64).view(np.uint64)


def near_links(points: DataFrame, radius: int = 2) -> DataFrame:
    """points: (fingerprint long), distinct. Edges (a, b) whose components are those of all links of `radius` bits or fewer."""
    spark = points.sparkSession
    total = points.count()
    shards = max(LEAST_SHARDS, min(SHARDS, -(-total // SHARD_POINTS)))
    sample = np.array([r[0] for r in points.orderBy(F.xxhash64("fingerprint"), "fingerprint").limit(min(SAMPLE, shards * 256)).collect()], dtype=np.int64).view(np.uint64)
    tree = Tree(sample, radius, max(1, len(sample) // shards))
    tree.number()
    _slim(tree)
    shared = spark.sparkContext.broadcast(tree)

    def deal(batches):
        for batch in batches:
            some = _as_points(batch.column(0))
            home, every = np.empty(len(some), dtype=np.int32), np.arange(len(some))
            shared.value.home(some, every, home)
            shard, place = [home], [every]
            for leaf, at in shared.value.reached(some, every, radius):
                later = at[home[at] < leaf.leaf]
                shard.append(np.full(len(later), leaf.leaf, dtype=np.int32))
                place.append(later)
            shard, place = np.concatenate(shard), np.concatenate(place)
            at_home = np.zeros(len(shard), dtype=bool)
            at_home[: len(some)] = True
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(some[place].view(np.int64)), pa.array(at_home)], names=["shard", "fingerprint", "home"])

    def search(rows: pa.Table) -> pa.Table:
        found, home = _as_points(rows.column("fingerprint")), np.asarray(rows.column("home"), dtype=bool)
        a, b = links(found[home], found[~home], radius) if home.any() else (found[:0], found[:0])
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return points.select("fingerprint").mapInArrow(deal, "shard int, fingerprint long, home boolean").groupBy("shard").applyInArrow(search, "a long, b long")


def _slim(tree: Tree) -> None:
    """The shards' tree travels without the sample."""
    if tree.vantage is None:
        tree.points = None
    else:
        _slim(tree.inside)
        _slim(tree.outside)


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) to (node, root), a row for each node that has a link and is not its component's least node."""
    stars = cut(edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).where("node <> root").distinct(), "edges")
    if stars.isEmpty():
        return stars
    before = None
    while True:
        both = stars.unionAll(stars.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.min("root").alias("least")).select("node", F.least("node", "least").alias("least"))
        large = both.join(least, "node").where("root > node").select(F.col("root").alias("node"), F.col("least").alias("root")).where("node <> root").distinct()
        small_least = large.groupBy("node").agg(F.min("root").alias("least"))
        small = large.join(small_least, "node").select(F.col("root").alias("node"), F.col("least").alias("root")).unionAll(small_least.select("node", F.col("least").alias("root")))
        stars = cut(small.where("node <> root").distinct(), "stars")
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(20,0)"))).first()
        if now == before:
            return stars
        before = now


def group(rows: DataFrame, radius: int = 2) -> DataFrame:
    """rows (doc_id, fingerprint) to (fingerprint, root, component_id): a row for each fingerprint."""
    points = cut(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "points")
    stars = components(near_links(points, radius))
    rooted = points.join(stars.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    named = cut(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "named")  # as a scan, so that a hot root's join can be split
    return rooted.join(named, "root").select("fingerprint", "root", "component_id")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id, the least doc_id of the component; a row for each row."""
    rows = cut(fingerprints(pick(df, doc_id=doc_id, text=text), "text", words, ["doc_id"]), "fingerprints")
    return rows.join(group(rows, radius), "fingerprint").select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


#: Rows of keys that may be broadcast when copies are dropped; more are joined by a shuffle.
BROADCAST_KEYS = 1 << 21


def drop_copies(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """Keeps one row of each component, that of the least doc_id (then of the least hash of text); columns stay as they are."""
    names = df.columns
    wide = df.toDF(*[f"c{i}" for i in range(len(names))])
    key, body = f"c{position(df, doc_id)}", f"c{position(df, text)}"
    wide = wide.withColumn("k", F.xxhash64(F.coalesce(F.col(body).cast("string"), F.lit("")), F.col(body).isNull()))
    rows = cut(fingerprints(wide.select(F.col(key).alias("doc_id"), "k", F.col(body).alias("text")), "text", words, ["doc_id", "k"]), "fingerprints")
    near = rows.groupBy("fingerprint", "doc_id", "k").agg(F.count("*").alias("rows")).join(group(rows, radius), "fingerprint")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k")
    near = cut(near, "near")
    best = cut(near.groupBy("root").agg(F.min(order).alias("best")), "best")
    judged = cut(near.join(best, "root").select("doc_id", "k", "rows", (order != F.col("best")).alias("drop")), "judged")
    dropped, repeated = judged.agg(F.count_if("drop"), F.max(F.when(~F.col("drop"), F.col("rows")))).first()
    gone = judged.where("drop").select(F.col("doc_id").alias("gone_id"), F.col("k").alias("gone_k"))
    kept = wide.join(F.broadcast(gone) if dropped <= BROADCAST_KEYS else gone, wide[key].eqNullSafe(F.col("gone_id")) & (wide["k"] == F.col("gone_k")), "left_anti")
    if (repeated or 0) > 1:
        kept = kept.dropDuplicates([key, "k"])
    return kept.drop("k").toDF(*names)
