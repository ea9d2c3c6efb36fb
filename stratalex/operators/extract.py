"""Extraction: a model names candidates in records; labels are normalised, parents resolved, evidence aggregated.

Records: record_id, text, institution, url and ord. A runner turns records into answers (record_id, answer: a JSON array of
objects label, normalized, aliases, parents)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.udfs import close_matches
from ..policies import LabelPolicy
from ..sources.shared import cut

ANSWER = "array<struct<label:string,normalized:string,aliases:array<string>,parents:array<string>>>"
#: Keys of parents that the fuzzy matcher holds at once; more are matched in further blocks. It is only asked for anchors
#: that no key equals.
MOST_KEYS = 50_000


def repaired(answer: Column) -> Column:
    """The JSON array in an answer: the answer itself, its candidates field, a single object as an array, or the first
    array or object between other words."""
    body = F.coalesce(F.nullif(F.regexp_extract(answer, r"(?s)^\s*([\[{].*[\]}])\s*$", 1), F.lit("")), F.nullif(F.regexp_extract(answer, r"(?s)(\[.*\]|\{.*\})", 1), F.lit("")))
    inner = F.get_json_object(body, "$.candidates")
    return F.when(body.startswith("["), body).when(inner.isNotNull(), inner).when(body.startswith("{"), F.concat(F.lit("["), body, F.lit("]")))


def parsed(answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(candidates, quarantine). candidates: record_id, label, normalized, aliases, parents, sorted by normalized in a record."""
    none = F.array().cast("array<string>")
    read = answers.select("record_id", "answer", F.from_json(repaired(F.col("answer")), ANSWER).alias("found"))
    each = read.where("found is not null").select("record_id", F.posexplode("found").alias("at", "c"))
    label, normal = tx.squeeze_ends("c.label"), tx.squeeze_ends("c.normalized")
    rows = each.where((label != "") & (normal != "")).select("record_id", "at", label.alias("label"), normal.alias("normalized"), F.coalesce("c.aliases", none).alias("aliases"), F.coalesce("c.parents", none).alias("parents"))
    return rows, read.where("found is null").select("record_id", "answer", F.lit("invalid-json").alias("reason"))


def normalized(candidates: DataFrame, records: DataFrame, level: int, policy: LabelPolicy = LabelPolicy()) -> DataFrame:
    """Canonical forms within the length bounds, with aliases, anchors of parents, fingerprint and institution. The form
    comes from the label; what the model called normalized is an alias."""
    wide = candidates.join(records.select("record_id", "text", "institution", "url", "ord"), "record_id")
    form = tx.canonical_form(F.col("label"), level, policy, F.col("institution"))
    wide = wide.select("*", form.alias("form")).where(F.length("form.canonical").between(max(1, policy.min_length), policy.max_length))
    names = F.filter(F.transform(F.concat(F.array("label", "normalized"), "aliases", "form.aliases"), tx.squeeze), lambda a: a != "")
    return wide.select("record_id", "ord", "at", F.lit(level).alias("level"), "label", F.col("form.canonical").alias("normalized"), F.array_distinct(names).alias("aliases"), F.transform("parents", lambda p: tx.squeeze(F.lower(p))).alias("anchors"), tx.record_fingerprint(F.col("text"), F.col("institution"), F.col("url")).alias("fingerprint"), "institution")


def parent_keys(parents: DataFrame, policy: LabelPolicy = LabelPolicy()) -> DataFrame:
    """key, parent_id, parent_level, ord: canonical forms of the labels and aliases of earlier levels. parents: level, label,
    aliases and, if known, id."""
    named = parents.select("level", "label", F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"), (F.col("id") if "id" in parents.columns else F.lit(None).cast("string")).alias("id"), (F.col("ord") if "ord" in parents.columns else F.lit(0)).alias("ord"))
    own = tx.canonical_at_any_level(F.col("label"), F.col("level"), policy)["canonical"]
    named = named.withColumn("own", own)
    id_ = F.coalesce("id", F.concat(F.lit("L"), F.col("level").cast("string"), F.lit(":"), F.coalesce(F.nullif(F.col("own"), F.lit("")), F.col("label"))))
    each = named.select(id_.alias("parent_id"), F.col("level").alias("parent_level"), "ord", "own", F.explode_outer("aliases").alias("alias"))
    alias = tx.canonical_at_any_level(F.col("alias"), F.col("parent_level"), policy)["canonical"]
    return each.select("parent_id", "parent_level", "ord", F.explode(F.array("own", alias)).alias("key")).where("key <> ''").distinct()


def anchor_forms(anchors: DataFrame, policy: LabelPolicy = LabelPolicy()) -> DataFrame:
    """anchor, level, form, rank: the anchor's canonical forms at each shallower level, the deepest first, each once."""
    forms = [F.when(F.greatest(F.col("level") - 1, F.lit(0)) >= k, tx.canonical_form(F.col("anchor"), k, policy)["canonical"]) for k in (3, 2, 1, 0)]
    found = F.array_distinct(F.filter(F.array(*forms), lambda f: f.isNotNull() & (f != "")))
    return anchors.select("anchor", "level", F.posexplode(found).alias("rank", "form"))


def resolve(anchors: DataFrame, keys: DataFrame, policy: LabelPolicy = LabelPolicy()) -> DataFrame:
    """anchor, level, parent_ids (in order, each once), how (exact, fuzzy or unresolved). anchors: distinct (anchor, level)."""
    forms = anchor_forms(anchors, policy)
    hits = forms.join(keys, (F.col("form") == F.col("key")) & (F.col("parent_level") < F.col("level")))
    exact = _ordered(hits, "rank").withColumn("how", F.lit("exact"))
    open_ = anchors.join(exact, ["anchor", "level"], "left_anti")
    near = _near(open_, keys, policy)
    out = exact
    if near is not None:
        found = near.join(keys, "key").where(F.col("parent_level") < F.col("level")).withColumn("rank", F.col("rank") * 10 + F.col("near"))
        out = out.unionByName(_ordered(found, "rank").withColumn("how", F.lit("fuzzy")))
    lost = anchors.join(out, ["anchor", "level"], "left_anti").select("anchor", "level", F.array(F.concat(F.lit("UNRESOLVED:"), tx.squeeze("anchor"))).alias("parent_ids"), F.lit("unresolved").alias("how"))
    return out.unionByName(lost)


def _near(open_: DataFrame, keys: DataFrame, policy: LabelPolicy) -> DataFrame | None:
    """anchor, level, rank, near (0 to 2) and key: the three closest keys of shallower levels for each form. Keys go in blocks
    of MOST_KEYS of one level; each block's best three are merged."""
    forms = anchor_forms(open_, policy)
    least = keys.groupBy("key").agg(F.min("parent_level").alias("first"))
    sizes = least.groupBy("first").count().orderBy("first").collect()
    several = sum(-(-r["count"] // MOST_KEYS) for r in sizes) > 1
    if several:
        forms, least = cut(forms, "forms"), cut(least, "keys")
    near = None
    for first, size in sizes:
        last = None
        for _ in range(-(-size // MOST_KEYS)):
            page = least.where(F.col("first") == first)
            page = page if last is None else page.where(F.col("key") > last)
            block = [r[0] for r in page.select("key").orderBy("key").limit(MOST_KEYS).collect()]
            last = block[-1]
            found = forms.where(F.col("level") > first).select("anchor", "level", "rank", F.explode(close_matches(F.col("form"), block, 3, policy.parent_similarity_cutoff)).alias("m"))
            found = cut(found, "near") if several else found
            near = found if near is None else near.unionAll(found)
    if near is None:
        return None
    best = near.groupBy("anchor", "level", "rank").agg(F.slice(F.sort_array(F.collect_list("m"), asc=False), 1, 3).alias("best"))
    return best.select("anchor", "level", "rank", F.posexplode("best").alias("near", "m")).select("anchor", "level", "rank", "near", F.col("m.key").alias("key"))


def _ordered(hits: DataFrame, rank: str) -> DataFrame:
    listed = F.array_sort(F.collect_set(F.struct(F.col(rank).alias("r"), "ord", "parent_id")))
    return hits.groupBy("anchor", "level").agg(F.array_distinct(F.transform(listed, lambda s: s["parent_id"])).alias("parent_ids"))


def with_parents(found: DataFrame, resolved: DataFrame) -> DataFrame:
    """Adds parents: ids of resolved anchors first, then unresolved ones; none at level 0."""
    each = found.select("record_id", "at", "level", F.posexplode("anchors").alias("n", "anchor")).where("level > 0").join(resolved, ["anchor", "level"])
    listed = F.array_sort(F.collect_list(F.struct((F.col("how") == "unresolved").alias("u"), "n", "parent_ids")))
    of = each.groupBy("record_id", "at").agg(F.array_distinct(F.flatten(F.transform(listed, lambda s: s["parent_ids"]))).alias("parents"))
    return found.join(of, ["record_id", "at"], "left").withColumn("parents", F.coalesce("parents", F.array().cast("array<string>")))


def aggregated(found: DataFrame) -> DataFrame:
    """One row for each (normalized, parents): label of the first, aliases, fingerprints, institutions, support. Rows below
    level 0 without parents pass only with one institution."""
    first = F.struct("ord", "at")
    groups = found.groupBy("level", "normalized", "parents").agg(
        F.min_by("label", first).alias("label"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.array_append("aliases", F.col("label")))))).alias("aliases"),
        F.array_sort(F.collect_set("fingerprint")).alias("record_fingerprints"),
        F.array_sort(F.collect_set("institution")).alias("institutions"),
        F.count("*").alias("n"),
    )
    support = F.struct(F.size("record_fingerprints").cast("long").alias("records"), F.size("institutions").cast("long").alias("institutions"), F.col("n").alias("count"))
    made = groups.select("level", "label", "normalized", "parents", "aliases", support.alias("support"), "institutions", "record_fingerprints")
    return made.where((F.col("level") == 0) | (F.size("parents") > 0) | (F.col("support.institutions") == 1))


def extract_level(records: DataFrame, level: int, runner: Callable[[DataFrame], DataFrame], parents: DataFrame | None = None, policy: LabelPolicy = LabelPolicy()) -> tuple[DataFrame, DataFrame]:
    """(candidates, quarantine) of one level. The runner's answers should be stored before use, so that retries see them."""
    found, bad = parsed(runner(records))
    found = normalized(found, records, level, policy)
    if level == 0 or parents is None:
        unresolved = found.select(F.explode("anchors").alias("anchor"), "level").distinct().select("anchor", "level", F.array(F.concat(F.lit("UNRESOLVED:"), F.col("anchor"))).alias("parent_ids"), F.lit("unresolved").alias("how"))
        return aggregated(with_parents(found, unresolved)), bad
    anchors = found.select(F.explode("anchors").alias("anchor"), "level").distinct()
    return aggregated(with_parents(found, resolve(anchors, parent_keys(parents, policy), policy))), bad


def consolidate(*levels: DataFrame) -> DataFrame:
    """The levels' candidates as one table."""
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out
