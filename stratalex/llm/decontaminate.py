"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

An item's windows of `window` consecutive words (one window of all its words, if it has fewer) are sets of word
shingles. A window occurs in a document only if every shingle of it does, so under a global order of the shingles
by rarity a prefix of one, the rarest, is enough to find every candidate. Document shingles that equal a prefix
shingle give candidates; the shingle's offset fixes where the window would begin, and the length and positional
bounds drop those that would stick out; the rest are compared word by word over exactly the window's span.

Rarity is counted over all documents. The windows are broadcast up to BROADCAST_WINDOWS of them, which bounds their
size; beyond that the same join goes through shuffles.

Defined cases: a null or wordless document has no words and no hits; a null or wordless item has no window; items with
the same words are all found; equal document rows give equal rows each; null ids are kept; an empty table on either
side gives no hits; very long texts are read whole; other columns are left aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import ascii_lower, cut, pick, position

BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, SHINGLE = 10, 3
BROADCAST_WINDOWS = 1 << 18
BROADCAST_KEYS = 1 << 21


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), BREAK), "")


def _key(size: int, from_: Column, at: Column) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(from_, at + k) for k in range(size)])


def windows_of(items: DataFrame, window: int) -> DataFrame:
    """item_id, wid, w: an item's distinct windows; wid stands for the words."""
    long_enough = items.select("item_id", words(F.col("text")).alias("all")).where(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("all") - window + 1))
    each = long_enough.select("item_id", "all", F.explode(starts).alias("at")).select("item_id", F.slice("all", F.col("at"), window).alias("w"))
    return each.select("item_id", F.unhex(F.md5(F.array_join("w", " ").cast("binary"))).alias("wid"), "w").distinct()


def shingles_of(windows: DataFrame, shingle: int) -> DataFrame:
    """wid, w, m, size, shift, key: each shingle of a window and where it begins in it."""
    sized = windows.select("wid", "w", F.size("w").alias("m"), F.least(F.size("w"), F.lit(shingle)).alias("size"))
    each = sized.select("*", F.explode(F.sequence(F.lit(0), F.col("m") - F.col("size"))).alias("shift"))
    key = F.coalesce(*[F.when(F.col("size") == s, _key(s, F.col("w"), F.col("shift"))) for s in range(1, shingle + 1)])
    return each.withColumn("key", key)


def document_shingles(documents: DataFrame, sizes: list[int], keep: list[str]) -> DataFrame:
    """A row for each document word and shingle size: at (place of the word, from 1; 0: a row for the document itself) and key."""
    each = documents.select(*keep, "dw", F.posexplode(F.concat(F.array(F.lit("")), F.col("dw"))).alias("at", "first"))
    keys = [F.when((F.col("at") > 0) & (F.col("at") + s - 1 <= F.size("dw")), _key(s, F.col("dw"), F.col("at") - 1)) for s in sizes]
    if len(keys) == 1:
        return each.withColumn("key", keys[0])
    return each.withColumn("key", F.explode(F.when(F.col("at") == 0, F.array(F.lit(None).cast("long"))).otherwise(F.array(*keys))))


def measure(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", window: int = WINDOW, shingle: int = SHINGLE, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """For each document: doc_id, text_hash, n_words, n_hit, item_ids (array of strings, sorted)."""
    shingle = min(shingle, window)
    docs = pick(documents, doc_id=doc_id, text=text).select("doc_id", F.xxhash64("text", F.col("text").isNull()).alias("text_hash"), words(F.col("text")).alias("dw"))
    member = cut(windows_of(pick(items, item_id=item_id, text=text), window), "windows")
    windows = member.select("wid", "w").distinct()
    parts = cut(shingles_of(windows, shingle), "shingles")
    sizes, few = [r[0] for r in parts.select("size").distinct().collect()], parts.count() <= broadcast_windows * (window - shingle + 1)
    small = F.broadcast if few else (lambda df: df)
    if not sizes:
        return docs.select("doc_id", "text_hash", F.size("dw").cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("item_ids"))

    counted = document_shingles(docs, sizes, []).where(F.col("key").isNotNull()).select("key").join(small(parts.select("key").distinct()), "key", "left_semi").groupBy("key").count()
    rarity = F.struct(F.coalesce("count", F.lit(0)), "key", "shift")
    prefix = cut(parts.join(counted, "key", "left").groupBy("wid", "w", "m").agg(F.min_by(F.struct("key", "shift"), rarity).alias("p")).select("wid", "w", "m", "p.key", "p.shift"), "prefix")

    start = F.col("at") - F.col("shift")
    bounds = (start >= 1) & (start + F.col("m") - 1 <= F.size("dw"))
    same = F.slice(F.col("dw"), F.greatest(start, F.lit(1)), F.col("m")) == F.col("w")
    found = [F.col("doc_id"), F.col("text_hash")]
    if few:
        each = document_shingles(docs, sizes, ["doc_id", "text_hash"]).alias("d").join(F.broadcast(prefix.alias("p")), (F.col("d.key") == F.col("p.key")) & bounds & same, "left").where((F.col("at") == 0) | F.col("wid").isNotNull())
        rows = each.select(*found, "at", F.size("dw").alias("n"), start.alias("start"), "m", "wid")
    else:
        grams = document_shingles(docs.withColumn("n", F.size("dw")), sizes, ["doc_id", "text_hash", "n"]).where(F.col("key").isNotNull()).drop("dw", "first")
        candidates = grams.join(prefix, "key").where((start >= 1) & (start + F.col("m") - 1 <= F.col("n"))).select(F.col("doc_id").alias("id"), F.col("text_hash").alias("h"), "at", "shift", "m", "wid", "w").distinct()
        met = docs.distinct().join(candidates, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("h"))).where(same)
        rows = met.select(*found, "at", F.size("dw").alias("n"), start.alias("start"), "m", "wid").unionByName(docs.select(*found, F.lit(0).alias("at"), F.size("dw").alias("n"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("m"), F.lit(None).cast("binary").alias("wid")))
    spans = F.sort_array(F.collect_set(F.when(F.col("wid").isNotNull(), F.struct("start", "m"))))
    per = rows.groupBy("doc_id", "text_hash").agg(F.count_if(F.col("at") == 0).alias("copies"), F.max("n").cast("long").alias("n_words"), spans.alias("spans"), F.collect_set("wid").alias("wids"))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).alias("end")),
        lambda a, s: F.struct((a["hit"] + F.greatest(F.lit(0), s["start"] + s["m"] - 1 - F.greatest(a["end"], s["start"] - 1))).alias("hit"), F.greatest(a["end"], s["start"] + s["m"] - 1).alias("end")),
        lambda a: a["hit"],
    )
    per = cut(per.select("doc_id", "text_hash", "copies", "n_words", covered.alias("n_hit"), "wids"), "hits")
    of = per.where(F.size("wids") > 0).select("doc_id", "text_hash", F.explode("wids").alias("wid")).join(member.select("wid", F.col("item_id").cast("string").alias("item")), "wid")
    of = of.groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("h")).agg(F.sort_array(F.collect_set("item")).alias("item_ids"))
    whole = per.join(of, per.doc_id.eqNullSafe(of.id) & (per.text_hash == of.h), "left")
    result = whole.select("doc_id", "text_hash", "n_words", "n_hit", F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return result.drop("copy")


def drop_contaminated(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """Documents without a hit word; columns stay as they are."""
    names = documents.columns
    wide = documents.toDF(*[f"c{i}" for i in range(len(names))])
    key, body = f"c{position(documents, doc_id)}", F.col(f"c{position(documents, text)}")
    hit = cut(measure(documents, items, doc_id=doc_id, text=text, **how).where("n_hit > 0").select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct(), "contaminated")
    hit = F.broadcast(hit) if hit.count() <= BROADCAST_KEYS else hit
    return wide.join(hit, wide[key].eqNullSafe(F.col("gone_id")) & (F.xxhash64(body, body.isNull()) == F.col("gone_hash")), "left_anti").toDF(*names)
