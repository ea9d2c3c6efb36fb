"""Pages to source records: language gate, segmentation into blocks, length gate, near-duplicate removal in a page.

Input rows: page (a key), text, lang, language_confidence and whatever provenance to carry."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..policies import ExtractionPolicy

LINE_BREAK = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]"
LIST_MARK = r"(?i)^(?:[-+*•‣◦]|\d+[.)]|[a-z][.)])\s+"


def language_allowed(lang: Column, confidence: Column, policy: ExtractionPolicy) -> Column:
    """Base language and confidence; a missing confidence counts as 0 unless none is asked for."""
    target = policy.target_language.lower()
    if not target:
        return F.lit(True)
    missing = 0.0 if target != "any" and policy.require_language_confidence else 1.0
    sure = F.when(confidence.isNull(), F.lit(missing)).otherwise(F.coalesce(confidence.try_cast("double"), F.lit(0.0))) >= policy.language_confidence_threshold
    return sure if target == "any" else sure & (F.substring_index(F.lower(F.coalesce(lang, F.lit("und"))), "-", 1) == target)


def is_header(line: Column, policy: ExtractionPolicy) -> Column:
    if not policy.detect_sections:
        return F.lit(False)
    n = F.size(F.split(tx.squeeze(line), " "))
    found = (line.endswith(":") & (n <= 12)) | ((F.upper(line) == line) & (F.lower(line) != line) & n.between(2, 12))
    for pattern in policy.section_header_patterns:
        found = found | line.rlike(f"(?i){pattern}")
    return found


def is_boilerplate(text: Column, policy: ExtractionPolicy) -> Column:
    if not policy.remove_boilerplate or not policy.boilerplate_patterns:
        return F.lit(False)
    return text.rlike("(?i)" + "|".join(f"(?:{p})" for p in policy.boilerplate_patterns))


def _gaps(line: Column) -> Column:
    """Where runs of three spaces or more begin."""
    places = F.filter(F.sequence(F.lit(1), F.length(line) - 2), lambda i: (F.substring(line, i, F.lit(3)) == "   ") & ((i == 1) | (F.substring(line, i - 1, F.lit(1)) != " ")))
    return F.when(F.contains(line, F.lit("   ")), places).otherwise(F.array().cast("array<int>"))


def _aligned(a: Column, b: Column) -> Column:
    return F.coalesce((F.size(a) >= 2) & (F.size(b) >= 2) & F.exists(a, lambda p: F.exists(b, lambda q: F.abs(p - q) <= 1)), F.lit(False))


def lines(pages: DataFrame, policy: ExtractionPolicy = ExtractionPolicy()) -> DataFrame:
    """page, at, raw, line, blank, header, kind (list, table or paragraph)."""
    each = pages.select("page", F.posexplode(F.split("text", LINE_BREAK)).alias("at", "raw"))
    each = each.select("*", tx.squeeze_ends("raw").alias("line"))
    each = each.select("*", (F.col("line") == "").alias("blank"), is_header(F.col("line"), policy).alias("header"))
    in_order = W.partitionBy("page").orderBy("at")
    table = F.lit(False)
    if policy.segment_on_tables:
        pipes = F.length(F.col("line")) - F.length(F.replace(F.col("line"), F.lit("|"), F.lit(""))) >= 2
        each = each.select("*", F.contains(F.col("raw"), F.lit("\t")).alias("tab"), _gaps(F.col("raw")).alias("gaps"))
        each = each.select("*", *[f(c).over(in_order).alias(f"{n}_{c}") for n, f in (("before", F.lag), ("after", F.lead)) for c in ("tab", "gaps")])
        tabs = F.col("tab") & (F.coalesce("before_tab", F.lit(False)) | F.coalesce("after_tab", F.lit(False)))
        table = ~F.col("blank") & (pipes | tabs | _aligned(F.col("gaps"), F.col("before_gaps")) | _aligned(F.col("gaps"), F.col("after_gaps")))
    listed = F.col("line").rlike(LIST_MARK) if policy.segment_on_lists else F.lit(False)
    return each.select("page", "at", "raw", "line", "blank", "header", F.when(listed, "list").when(table, "table").otherwise("paragraph").alias("kind"))


def blocks(pages: DataFrame, policy: ExtractionPolicy = ExtractionPolicy()) -> DataFrame:
    """page, ord, section, block_type, text and boilerplate; ord counts the blocks that are no boilerplate.

    A block is an island of lines of one kind between blanks and headers; a header is a block of its own and names the
    section of what follows. One shuffle on page serves all windows and the grouping."""
    in_order = W.partitionBy("page").orderBy("at")
    so_far = in_order.rowsBetween(W.unboundedPreceding, 0)
    each = lines(pages, policy)
    each = each.select("*", F.last(F.when(F.col("header") & ~F.col("blank"), F.col("line")), ignorenulls=True).over(so_far).alias("section"))
    breaks = F.col("blank") | F.col("header")
    before = F.lag(F.struct(breaks.alias("broken"), "kind")).over(in_order)
    starts = breaks | before.isNull() | before["broken"] | (before["kind"] != F.col("kind"))
    each = each.select("*", F.sum(starts.cast("int")).over(so_far).alias("island")).where(~F.col("blank"))
    if not policy.segment_on_headers:
        each = each.where(~F.col("header"))
    shown = F.col("line")
    if not policy.preserve_list_structure:
        bare = tx.squeeze_ends(F.regexp_replace("line", LIST_MARK, ""))
        shown = F.when((F.col("kind") == "list") & (bare != ""), bare).otherwise(shown)
    kind = F.when(F.col("header"), "header").otherwise(F.col("kind"))
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", shown.alias("said")))), lambda s: s["said"]), "\n")
    made = each.groupBy("page", "island").agg(F.first("section").alias("section"), F.first(kind).alias("block_type"), said.alias("said"))
    whole = (F.col("block_type") == "list") & F.lit(policy.preserve_list_structure)
    made = made.select("page", "island", "section", "block_type", F.when(whole, tx.squeeze_ends("said")).otherwise(tx.squeeze("said")).alias("text")).where("text <> ''")
    made = made.select("*", is_boilerplate(F.col("text"), policy).alias("boilerplate"))
    by_island = W.partitionBy("page").orderBy("island")
    order = F.sum((~F.col("boilerplate")).cast("int")).over(by_island.rowsBetween(W.unboundedPreceding, 0)) - 1
    return made.select("page", F.when(~F.col("boilerplate"), order).alias("ord"), "section", "block_type", "text", "boilerplate")


def _words(text: str) -> list[str]:
    return "".join(c if c.isalnum() or c == "_" else " " for c in text.lower()).split()


def greedy_duplicates(texts: list[str], threshold: float, n: int = 3) -> list[int]:
    """Places of texts that are like an earlier kept one: shingle Jaccard of the threshold or more."""
    kept: list[frozenset] = []
    by_shingle: dict[str, list[int]] = {}
    out = []
    for i, text in enumerate(texts):
        w = _words(text)
        own = frozenset(" ".join(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()
        near = {k for s in own for k in by_shingle.get(s, ())} if own else {k for k, s in enumerate(kept) if not s}
        if any((1.0 if not own and not kept[k] else len(own & kept[k]) / len(own | kept[k])) >= threshold for k in near):
            out.append(i)
            continue
        for s in own:
            by_shingle.setdefault(s, []).append(len(kept))
        kept.append(own)
    return out


def drop_near_copies(found: DataFrame, policy: ExtractionPolicy = ExtractionPolicy()) -> DataFrame:
    """Blocks without those like an earlier block of the page. Exact copies go by a window; only pages with blocks left
    to compare reach the vectorised function."""
    if not policy.dedup_enabled:
        return found

    first = found.withColumn("copy", F.row_number().over(W.partitionBy("page", tx.comparable(F.col("text"))).orderBy("ord"))).where("copy = 1").drop("copy")

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def like(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: greedy_duplicates(list(x), policy.similarity_threshold))

    several = first.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("ord", "text"))).alias("all")).where(F.size("all") > 1)
    gone = several.select("page", F.col("all.ord").alias("ords"), like("all.text").alias("gone")).select("page", F.explode(F.transform("gone", lambda i: F.get("ords", i))).alias("ord"))
    return first.join(gone, ["page", "ord"], "left_anti")


def source_records(pages: DataFrame, policy: ExtractionPolicy = ExtractionPolicy()) -> DataFrame:
    """page, ord, text, provenance and meta of the blocks kept. pages has institution, url, canonical_url and fetched_at too."""
    allowed = pages.where(language_allowed(F.col("lang"), F.col("language_confidence"), policy))
    found = blocks(allowed, policy).where(~F.col("boilerplate") & F.length("text").between(policy.min_chars, policy.max_chars))
    kept = drop_near_copies(found.drop("boilerplate"), policy)
    told = allowed.select("page", "institution", F.coalesce("canonical_url", "url").alias("url"), "fetched_at", "lang", "language_confidence")
    sure = F.format_string("%.3f", F.col("language_confidence").try_cast("double"))
    hints = F.map_filter(F.create_map(F.lit("source"), F.lit("web"), F.lit("level"), F.lit("S0"), F.lit("language_confidence"), F.when(F.col("language_confidence").isNotNull(), sure), F.lit("block_type"), F.col("block_type"), F.lit("order"), F.col("ord").cast("string")), lambda k, v: v.isNotNull() & (v != ""))
    provenance = F.struct("institution", "url", "section", "fetched_at")
    meta = F.struct(F.lower(F.col("lang")).alias("language"), F.lit(None).cast("string").alias("charset"), hints.alias("hints"))
    return kept.join(told, "page").select("page", "ord", "text", provenance.alias("provenance"), meta.alias("meta"))


def metrics(pages: DataFrame, policy: ExtractionPolicy = ExtractionPolicy()) -> DataFrame:
    """lang, pages_seen, pages_skipped: the language counters."""
    return pages.groupBy("lang").agg(F.count("*").alias("pages_seen"), F.count_if(~language_allowed(F.col("lang"), F.col("language_confidence"), policy)).alias("pages_skipped"))
