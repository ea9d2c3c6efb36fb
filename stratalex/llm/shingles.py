"""Near copies by exact Jaccard similarity of word shingles.

1. Every text becomes the set of its word shingles (five words, ASCII lower case; fewer words make one shingle of all of
   them). Equal sets become one point.
2. Each point gets the SimHash fingerprint of its set. The vantage-point trees of simhash give the links of up to RADIUS bits as a
   forest; points of a fingerprint are candidates with its least point, near fingerprints by their least points.
3. SimHash alone loses links: sets of similarity 0.8 differ by 3 to 11 bits. So each point also gets BANDS keys, each of ROWS
   least hash values of its set (MinHash). Two sets of similarity 0.8 share none with a probability of
   (1 - 0.8 ** ROWS) ** BANDS = 5e-8; points that share a key are candidates. All links are confirmed on the sets themselves, first
   those of the trees and of each key's points to its least point, so a large group of copies costs one row a copy and key.
4. Points of keys that still hold several components are joined exactly: shingles are ordered by rarity among these points, and
   points of different components meet only under a shingle of both prefixes that the length and positional bounds admit; first
   each with the shingle's most central point (the fewest rarer shingles before it), then with all that are still apart and
   whose parity bits (PARITIES) do not already differ in more places than two similar sets can.
   So near misses, however many share a key, are told apart by their own rare shingles before they meet.
5. Confirmed links become components by simhash.components.

Defined cases: null, empty and wordless texts are one point; other columns are left aside.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import cut, position, with_columns
from .simhash import SEED, components, majority, near_links

WORDS, LEAST = 5, 0.8
BANDS, ROWS = 32, 4
RADIUS = 2
_RANDOM = np.random.default_rng(SEED)
_MIX = _RANDOM.integers(0, 1 << 64, (2, BANDS * ROWS), dtype=np.uint64) | np.uint64(1)
#: Hash values mixed at once.
STEP = 2048


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Distinct XXH64 values of the word shingles, ascending."""
    found = text.encode().lower().split() if text else []
    if not found:
        return np.empty(0, dtype=np.uint64)
    line = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]).tolist()
    digest = xxhash.xxh64_intdigest
    values = [digest(line[a : b - 1], SEED) for a, b in zip([0, *ends], ends[words - 1 :])] if len(found) > words else [digest(line, SEED)]
    return np.unique(np.array(values, dtype=np.uint64))


def band_keys(values: np.ndarray) -> np.ndarray:
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for k in range(0, len(values), STEP):
        mixed = (values[k : k + STEP, None] ^ _MIX[1]) * _MIX[0]
        np.minimum(least, (mixed ^ (mixed >> np.uint64(32))).min(axis=0), out=least)
    rows = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), seed) for seed, r in enumerate(rows)], dtype=np.uint64)


def _described(texts: list, words: int) -> list[list]:
    point, fingerprint, bands = [], [], []
    for t in texts:
        values = shingles(t, words)
        point.append(int(np.uint64(xxhash.xxh64_intdigest(values.tobytes(), SEED)).view(np.int64)))
        fingerprint.append(majority(values))
        bands.append(band_keys(values).view(np.int64).tolist())
    return [point, fingerprint, bands]


#: Long values that hold the parities of a set.
PARITIES = 8


def _sets(texts: list, words: int) -> list[list]:
    """Each text's shingles, and for each of 64 * PARITIES residues whether an odd number of them has it."""
    found = [shingles(t, words) for t in texts]
    bits = 64 * PARITIES
    odd = [np.packbits(np.bincount((v % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).view(np.int64) for v in found]
    return [[v.view(np.int64).tolist() for v in found], [v.tolist() for v in odd]]


def _confirmed(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) whose sets are similar enough."""
    both = pairs.join(sets.toDF("b", "y"), "b").join(sets.toDF("a", "x"), "a")
    common, total = F.size(F.array_intersect("x", "y")), F.size("x") + F.size("y")
    return both.where(common >= F.lit(least) * (total - common)).select("a", "b")


def _links(points: DataFrame, texts: DataFrame, words: int, least: float) -> DataFrame:
    """points (point, fingerprint, bands, k, one: the id of a row with k), texts (doc_id, k, text): (node, root) of each point that has a link and is not its component's least."""
    each = points.select("point", F.explode("bands").alias("key"))
    shared = each.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    members = cut(each.join(shared, "key"), "members")
    tried = tree_pairs(points)
    met = members.select("point").unionAll(tried.select("a")).unionAll(tried.select("b")).distinct()
    wanted = points.select("point", "k", "one").join(met, "point")
    # By text and id, so that copies of a text spread over tasks, and only one of them is kept
    asked = wanted.select(F.col("k").alias("ask_k"), F.col("one").alias("ask_id"))
    held = texts.join(asked, (F.col("k") == F.col("ask_k")) & F.col("doc_id").eqNullSafe(F.col("ask_id")))
    held = cut(held.groupBy("k").agg(F.min("text").alias("text")), "held")
    schema = pa.schema([("s", pa.list_(pa.int64())), ("parity", pa.list_(pa.int64()))])
    made = cut(wanted.join(with_columns(held, ["text"], lambda t: _sets(t, words), schema, ["k"]), "k").select("point", "s", "parity"), "sets")
    sets, parities = made.select("point", "s"), made.select("point", "parity")
    starred = _starred(members, members.groupBy("key").agg(F.min("point").alias("a")), F.lit(True))
    edges = cut(_confirmed(_pairs(tried.unionAll(starred)), sets, least), "links")
    stars = components(edges)
    now = _rooted(members, stars)
    several = now.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    open_ = now.join(several, "key").select("point").distinct()
    prefixes = cut(_prefixes(cut(sets.join(open_, "point"), "open"), least), "prefixes")
    for star in (True, False):
        found = _confirmed(_pairs(_prefix_pairs(_rooted(prefixes, stars), parities, star, least)), sets, least)
        edges = cut(edges.unionAll(found), "links")
        stars = components(edges)
    return stars


def tree_pairs(points: DataFrame, radius: int = RADIUS) -> DataFrame:
    """points (point, fingerprint): candidates (a, b) whose fingerprints are linked by up to `radius` bits, a spanning forest of them."""
    least = cut(points.groupBy("fingerprint").agg(F.min("point").alias("a")), "fingerprints")
    same = points.select("point", "fingerprint").join(least, "fingerprint").where("a <> point").select("a", F.col("point").alias("b"))
    near = near_links(least.select("fingerprint"), radius).toDF("x", "y")
    near = near.join(least.withColumnRenamed("fingerprint", "x"), "x").join(least.toDF("y", "b"), "y").select("a", "b")
    return cut(same.unionAll(near), "tree-pairs")


def _rooted(rows: DataFrame, stars: DataFrame) -> DataFrame:
    return rows.join(stars.withColumnRenamed("node", "point"), "point", "left").withColumn("root", F.coalesce("root", "point"))


def _starred(rows: DataFrame, centres: DataFrame, admitted: Column) -> DataFrame:
    return rows.join(centres, "key").where((F.col("a") != F.col("point")) & admitted).select("a", F.col("point").alias("b"))


def _pairs(found: DataFrame) -> DataFrame:
    return cut(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")


#: Bounds are widened by this, so that rounding never drops a link.
_SLACK = 1e-6


def _prefixes(sets: DataFrame, least: float) -> DataFrame:
    """(key, point, size, place, inner): the shared shingles of each set's prefix in order of rarity. A similar set that is not
    smaller has its first common shingle where `inner` is true; one that is not larger has it in the whole prefix."""
    each = sets.select("point", F.size("s").alias("size"), F.explode("s").alias("key"))
    counts = each.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    ranked = each.join(counts, "key").groupBy("point", "size").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("shared"))
    placed = ranked.select("point", "size", F.posexplode("shared").alias("at", "one"), (F.col("size") - F.size("shared")).alias("own"))
    rows = placed.select(F.col("one.key").alias("key"), "point", "size", (F.col("own") + F.col("at")).alias("place"))

    def prefix(share: float) -> Column:
        return F.col("place") <= F.col("size") - F.ceil(F.col("size") * share - _SLACK)

    return rows.where(prefix(least)).withColumn("inner", prefix(2 * least / (1 + least)))


def _admitted(least: float, x: str, y: str) -> Column:
    """The length bound, and the positional bound on what two sets can share around a common shingle."""
    size = [F.col(f"{side}size") for side in (x, y)]
    place = [F.col(f"{side}place") for side in (x, y)]
    most = F.least(*place) + F.least(*[n - at for n, at in zip(size, place, strict=True)])
    return (F.least(*size) >= F.greatest(*size) * least - _SLACK) & (most * (1 + least) >= (size[0] + size[1]) * least - _SLACK)


def _unlike(x: str, y: str) -> Column:
    """Residues whose parities differ: two sets differ by as many shingles at least, whatever they share."""
    return sum((F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(PARITIES)), F.lit(0))


def _prefix_pairs(rows: DataFrame, parities: DataFrame, star: bool, least: float) -> DataFrame:
    """Pairs (a, b) of different components under a key: of each point and the key's most central one, or of all."""
    apart = F.col("aroot") != F.col("root")
    if star:
        centre = F.min(F.struct("place", "point", "size", "root")).alias("c")
        centres = rows.groupBy("key").agg(centre).select("key", *[F.col(f"c.{c}").alias("a" if c == "point" else f"a{c}") for c in ("point", "place", "size", "root")])
        return _starred(rows, centres, apart & _admitted(least, "a", ""))
    several = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    rows = cut(rows.join(several, "key").join(parities, "point"), "apart")
    smaller = rows.where("inner").select("key", F.col("point").alias("a"), *[F.col(c).alias(f"a{c}") for c in ("size", "place", "root", "parity")])
    ordered = F.struct("asize", "a") < F.struct("size", "point")
    near = _unlike("aparity", "parity") * (1 + least) <= (F.col("asize") + F.col("size")) * (1 - least) + _SLACK
    return smaller.join(rows, "key").where(ordered & apart & _admitted(least, "a", "") & near).select("a", F.col("point").alias("b"))


#: Rows of keys that may be broadcast when copies are dropped; more are joined by a shuffle.
BROADCAST_KEYS = 1 << 21


def drop_similar(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, least: float = LEAST) -> DataFrame:
    """Keeps one row of each component, that of the least doc_id (then of the least hash of text); columns stay as they are."""
    names = df.columns
    wide = df.toDF(*[f"c{i}" for i in range(len(names))])
    key, body = f"c{position(df, doc_id)}", f"c{position(df, text)}"
    wide = wide.withColumn("k", F.xxhash64(F.coalesce(F.col(body).cast("string"), F.lit("")), F.col(body).isNull()))
    schema = pa.schema([("point", pa.int64()), ("fingerprint", pa.int64()), ("bands", pa.list_(pa.int64()))])
    rows = cut(with_columns(wide.select(F.col(key).alias("doc_id"), "k", F.col(body).alias("text")), ["text"], lambda t: _described(t, words), schema, ["doc_id", "k"]), "shingled")
    first = F.min_by(F.struct("fingerprint", "bands", "k", F.col("doc_id").alias("one")), F.struct("k", "doc_id")).alias("first")
    points = cut(rows.groupBy("point").agg(first).select("point", "first.*"), "points")
    stars = _links(points, wide.select(F.col(key).alias("doc_id"), "k", F.col(body).alias("text")), words, least)
    near = rows.groupBy("point", "doc_id", "k").agg(F.count("*").alias("rows")).join(stars.withColumnRenamed("node", "point"), "point", "left").withColumn("root", F.coalesce("root", "point"))
    near = cut(near, "near")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k")
    best = cut(near.groupBy("root").agg(F.min(order).alias("best")), "best")
    judged = cut(near.join(best, "root").select("doc_id", "k", "rows", (order != F.col("best")).alias("drop")), "judged")
    dropped, repeated = judged.agg(F.count_if("drop"), F.max(F.when(~F.col("drop"), F.col("rows")))).first()
    gone = judged.where("drop").select(F.col("doc_id").alias("gone_id"), F.col("k").alias("gone_k"))
    kept = wide.join(F.broadcast(gone) if dropped <= BROADCAST_KEYS else gone, wide[key].eqNullSafe(F.col("gone_id")) & (wide["k"] == F.col("gone_k")), "left_anti")
    if (repeated or 0) > 1:
        kept = kept.dropDuplicates([key, "k"])
    return kept.drop("k").toDF(*names)
