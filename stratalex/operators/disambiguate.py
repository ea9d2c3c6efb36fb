"""Disambiguation: labels that several lineages share are found, and split into senses that a model names.

Concepts: id, ord, level, canonical_label, parents, aliases, support, and, if known, institutions. Records of a concept:
concept_id, n (place), text, institution, url."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import similarity as sm
from ..functions import text as tx
from ..policies import DisambiguationPolicy

NONE = "array<string>"


def windows(concepts: DataFrame, records: DataFrame, size: int = 100) -> DataFrame:
    """concept_id, source_index, text, institution, parent_lineage, url: words around each mention of the label in the concept's
    own records (half of size on either side); a record without a mention gives its first words. Each text of a record once."""
    if size <= 0:
        raise ValueError("the window must be positive")
    radius = max(1, size // 2)
    wide = records.join(concepts.select(F.col("id").alias("concept_id"), "canonical_label", tx.lineage_key(F.col("level"), F.coalesce("parents", F.array().cast(NONE))).alias("parent_lineage")), "concept_id")
    raw = F.filter(F.split(tx.squeeze("text"), " "), lambda t: t != "")
    target = F.filter(F.split(tx.squeeze(F.lower("canonical_label")), " "), lambda t: t != "")
    wide = wide.select("concept_id", F.col("n").alias("source_index"), "institution", "url", "parent_lineage", raw.alias("raw"), target.alias("target")).where(F.size("raw") > 0)
    span, n = F.size("target"), F.size("raw")
    low = F.transform("raw", F.lower)
    hits = tx._let(low, lambda x: F.filter(F.sequence(F.lit(1), F.greatest(n - span + 1, F.lit(1))), lambda i: (span > 0) & (F.slice(x, i, F.greatest(span, F.lit(1))) == F.col("target"))))
    wide = wide.withColumn("hits", hits)

    def around(i: Column) -> Column:
        start = F.greatest(F.lit(1), i - radius)
        return F.array_join(F.slice("raw", start, F.least(n, i - 1 + span + radius) - start + 1), " ")

    found = F.when(F.size("hits") > 0, F.array_distinct(F.transform("hits", around))).otherwise(F.array(F.array_join(F.slice("raw", 1, size), " ")))
    return wide.select("concept_id", "source_index", F.explode(found).alias("text"), "institution", "parent_lineage", "url")


def limited(found: DataFrame, policy: DisambiguationPolicy = DisambiguationPolicy()) -> DataFrame:
    """The first max_contexts_per_parent windows of each concept, in order of institution, record and text."""
    if policy.max_contexts_per_parent <= 0:
        return found
    rank = F.row_number().over(W.partitionBy("concept_id").orderBy(F.coalesce("institution", F.lit("")), "source_index", "text"))
    return found.withColumn("__n", rank).where(F.col("__n") <= policy.max_contexts_per_parent).drop("__n")


def summaries(found: DataFrame, most: int = 10) -> DataFrame:
    """Each text of a concept once, the first `most` in order: what a model is shown."""
    if most <= 0:
        raise ValueError("the number of contexts must be positive")
    order = F.struct(F.coalesce("institution", F.lit("")), "source_index")
    once = found.groupBy("concept_id", "text").agg(F.min_by(F.struct("institution", "source_index", "parent_lineage", "url"), order).alias("f")).select("concept_id", "text", "f.*")
    rank = F.row_number().over(W.partitionBy("concept_id").orderBy(F.coalesce("institution", F.lit("")), "source_index", "text"))
    return once.withColumn("place", rank).where(F.col("place") <= most)


def cooccurrence(found: DataFrame, least: int = 2) -> DataFrame:
    """token, count over the texts of windows, for tokens seen `least` times or more."""
    if least <= 0:
        raise ValueError("the least frequency must be positive")
    return found.select(F.explode(tx.context_tokens(F.col("text"))).alias("token")).groupBy("token").agg(F.count("*").alias("count")).where(F.col("count") >= least)


def institution_sets(concepts: DataFrame) -> DataFrame:
    """id, places: lower-case institutions of each concept; one mark for those that only have a count."""
    none = F.array().cast(NONE)
    named = F.col("institutions") if "institutions" in concepts.columns else none
    places = F.array_distinct(F.filter(F.transform(F.coalesce(named, none), lambda i: F.lower(tx.squeeze_ends(i))), lambda i: i != ""))
    return concepts.select("id", F.when(F.size(places) > 0, places).when(F.col("support.institutions") > 0, F.array(F.lit("__aggregate__"))).otherwise(none).alias("places"))


def collisions(concepts: DataFrame, found: DataFrame | None = None, policy: DisambiguationPolicy = DisambiguationPolicy()) -> DataFrame:
    """A row for each label that several concepts share: label, ids (in order), parent_divergence, context_overlap,
    context_divergence, institution_divergence, score and status (flagged, or why not).

    Means over all pairs of a group come from a self-join on the label, which combines within groups only."""
    none = F.array().cast(NONE)
    rows = concepts.select("id", "ord", "canonical_label", "level", F.coalesce("parents", none).alias("parents"), tx.lineage_key(F.col("level"), F.coalesce("parents", none)).alias("lineage"), F.lower(tx.squeeze_ends("canonical_label")).alias("label"))
    groups = rows.groupBy("label").agg(F.count("*").alias("size"), F.count_distinct("lineage").alias("lineages"), F.array_sort(F.collect_list(F.struct("ord", "id"))).alias("members"), F.min_by("canonical_label", "ord").alias("canonical_label"), F.min_by("level", "ord").alias("level")).where("size > 1")
    of = rows.join(groups.select("label"), "label", "left_semi").join(institution_sets(concepts), "id")
    if found is None:
        of = of.withColumn("tokens", none)
    else:
        seen = found.groupBy("concept_id").agg(F.array_distinct(F.flatten(F.collect_list(tx.context_tokens(F.col("text"))))).alias("tokens"))
        of = of.join(seen.withColumnRenamed("concept_id", "id"), "id", "left").withColumn("tokens", F.coalesce("tokens", none))
    cols = ["ord", "parents", "places", "tokens"]
    a = of.select("label", *[F.col(c).alias(f"a_{c}") for c in cols])
    b = of.select("label", *[F.col(c).alias(f"b_{c}") for c in cols])
    both = a.join(b, "label").where("a_ord < b_ord")
    filled = (F.size("a_tokens") > 0) & (F.size("b_tokens") > 0)
    placed = (F.size("a_places") > 0) & (F.size("b_places") > 0)
    means = both.groupBy("label").agg(
        (1 - F.avg(sm.jaccard(F.col("a_parents"), F.col("b_parents")))).alias("parent_divergence"),
        F.coalesce(F.avg(F.when(filled, sm.jaccard(F.col("a_tokens"), F.col("b_tokens")))), F.lit(0.0)).alias("context_overlap"),
        F.coalesce(F.avg(F.when(placed, 1 - sm.jaccard(F.col("a_places"), F.col("b_places")))), F.lit(0.0)).alias("institution_divergence"),
    )
    wide = groups.join(means, "label").withColumn("context_divergence", 1 - F.least("context_overlap", F.lit(1.0)))
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.4 * F.col("parent_divergence") + 0.35 * F.col("context_divergence") + 0.25 * F.col("institution_divergence")))
    wide = wide.withColumn("score", score)
    status = F.when(F.lit(policy.require_multiple_parents) & (F.col("lineages") < 2), "single-parent").when(F.col("parent_divergence") < policy.min_parent_divergence, "parent-threshold").when(F.col("context_overlap") > policy.max_context_overlap, "context-overlap").when(F.col("score") <= 0, "low-score").otherwise("flagged")
    return wide.select("label", "canonical_label", "level", F.transform("members", lambda m: m["id"]).alias("ids"), "size", "parent_divergence", "context_overlap", "context_divergence", "institution_divergence", "score", status.alias("status"))


def senses(answers: DataFrame, policy: DisambiguationPolicy = DisambiguationPolicy()) -> DataFrame:
    """label, separable, confidence, reason, senses (array of struct(label, gloss, hints, evidence)) from a model's JSON answers."""
    shape = "struct<separable:string,confidence:string,score:string,reason:string,senses:array<struct<label:string,title:string,gloss:string,description:string,parent_hints:array<string>,parents:array<string>,evidence_indices:array<int>,evidence:array<int>>>>"
    read = answers.select("label", F.from_json("answer", shape).alias("a"))

    def one(s: Column, i: Column) -> Column:
        name = F.coalesce(F.nullif(tx.squeeze_ends(F.coalesce(F.nullif(s["label"], F.lit("")), s["title"])), F.lit("")), F.concat(F.lit("Sense "), (i + 1).cast("string")))
        gloss = tx.squeeze_ends(F.coalesce(F.nullif(s["gloss"], F.lit("")), s["description"], F.lit("")))
        hints = F.filter(F.transform(F.coalesce(s["parent_hints"], s["parents"], F.array().cast(NONE)), lambda h: F.lower(tx.squeeze_ends(h))), lambda h: h != "")
        return F.struct(name.alias("label"), F.when(gloss == "", gloss).otherwise(tx.capped_gloss(gloss, policy.gloss_max_words)).alias("gloss"), hints.alias("hints"), F.coalesce(s["evidence_indices"], s["evidence"], F.array().cast("array<int>")).alias("evidence"))

    found = F.transform(F.coalesce("a.senses", F.array().cast("array<struct<label:string,title:string,gloss:string,description:string,parent_hints:array<string>,parents:array<string>,evidence_indices:array<int>,evidence:array<int>>>")), one)
    said = F.lower(F.trim("a.separable"))
    enough = F.size("a.senses") >= 2
    separable = F.coalesce(enough, F.lit(False)) & F.coalesce(F.when(said.isin("true", "yes", "y", "1", "t"), True).when(said.isin("false", "no", "n", "0", "f"), False), F.lit(True))
    sure = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(F.coalesce("a.confidence", "a.score").try_cast("double"), F.lit(0.0))))
    return read.select("label", separable.alias("separable"), sure.alias("confidence"), F.coalesce("a.reason", F.lit("")).alias("reason"), found.alias("senses"))


def shares(total: Column, weights: Column, least_one: bool = False) -> Column:
    """Whole shares of a total by weights: banker's rounding, then ones added or taken in turn until they sum to it.

    What is added in turn has a closed form; what is taken skips shares that are zero, which a fold over at most the sum of
    roundings does."""
    n = F.size(weights)
    whole = F.aggregate(weights, F.lit(0.0), lambda a, w: a + w)
    part = F.transform(weights, lambda w: F.bround(total * F.when(whole > 0, w / whole).otherwise(1.0 / n)).cast("long"))
    if least_one:
        part = F.when(total > 0, F.transform(part, lambda p: F.greatest(F.lit(1).cast("long"), p))).otherwise(F.transform(part, lambda p: F.lit(0).cast("long")))

    def balanced(p: Column) -> Column:
        delta = total - F.aggregate(p, F.lit(0).cast("long"), lambda a, x: a + x)
        more = F.transform(p, lambda x, i: x + F.floor(delta / n) + F.when(i < F.pmod(delta, n), 1).otherwise(0))

        def take(s: Column, _: Column) -> Column:
            at = F.pmod(s["i"], n)
            can = F.get(s["p"], at) > 0
            left = F.transform(s["p"], lambda x, k: F.when((k == at) & can & (s["d"] > 0), x - 1).otherwise(x))
            return F.struct(left.alias("p"), (s["i"] + 1).alias("i"), (s["d"] - F.when(can & (s["d"] > 0), 1).otherwise(0)).alias("d"))

        turns = F.sequence(F.lit(1), F.greatest(F.lit(1), (-delta + 1) * n).cast("int"))
        less = F.aggregate(turns, F.struct(p.alias("p"), F.lit(0).alias("i"), (-delta).cast("int").alias("d")), take, lambda s: s["p"])
        return F.when(delta >= 0, more).otherwise(less)

    return tx._let(part, balanced)


def split(concepts: DataFrame, flagged: DataFrame, answers: DataFrame, policy: DisambiguationPolicy = DisambiguationPolicy()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(concepts, splits, deferred). flagged: collisions whose status is flagged; answers: senses() of their labels."""
    none = F.array().cast(NONE)
    joined = flagged.join(answers, "label")
    sure = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.6 * F.col("confidence") + 0.4 * F.col("context_divergence")))
    lineage = concepts.select("id", "ord", tx.lineage_key(F.col("level"), F.coalesce("parents", none)).alias("lineage"), F.coalesce("parents", none).alias("parents"))
    groups = joined.select("label", F.explode("ids").alias("id")).join(lineage, "id").groupBy("label").agg(F.array_sort(F.collect_list(F.struct("ord", "lineage", "parents"))).alias("lineages"))
    joined = joined.join(groups, "label").withColumn("sure", sure)

    def parents_of(s: Column) -> Column:
        """Parents of the first lineage that holds one of the hints, hints in order; else those of the first concept."""
        by_hint = F.filter(F.transform(s["hints"], lambda h: F.get(F.transform(F.filter("lineages", lambda g: F.contains(F.lower(g["lineage"]), h)), lambda g: g["parents"]), F.lit(0))), lambda p: p.isNotNull() & (F.size(p) > 0))
        return F.coalesce(F.get(by_hint, F.lit(0)), F.get("lineages", F.lit(0))["parents"])

    joined = joined.withColumn("mapped", F.transform("senses", parents_of))
    kinds = F.size(F.array_distinct(F.transform("mapped", lambda p: F.array_join(F.array_sort(F.array_distinct(p)), "\u0001"))))
    reason = (
        F.when(~F.col("separable"), "the model gave no distinct senses")
        .when(F.col("sure") <= policy.defer_threshold, "confidence is below the threshold to defer")
        .when(F.col("sure") < policy.min_evidence_strength, "confidence is below the threshold to split")
        .when(F.lit(not policy.allow_multi_parent_exceptions) & (kinds < F.size("mapped")), "senses share a lineage")
    )
    joined = joined.withColumn("why", reason)
    deferred = joined.where("why is not null").select(F.explode("ids").alias("id"), "label", F.col("why").alias("reason"))
    done = joined.where("why is null")

    member = done.select("label", F.explode("ids").alias("id")).join(concepts, "id")
    sums = member.groupBy("label").agg(F.struct(F.sum("support.records").alias("records"), F.sum("support.institutions").alias("institutions"), F.sum("support.count").alias("count")).alias("all_support"), F.array_distinct(F.flatten(F.collect_list(F.concat(F.array("canonical_label"), F.coalesce("aliases", none))))).alias("names"), F.min("ord").alias("first_ord"))
    wide = done.join(sums, "label").withColumn("weights", F.transform("senses", lambda s: F.greatest(F.lit(1.0), F.size(s["evidence"]).cast("double"))))
    wide = wide.select("*", shares(F.col("all_support.records"), F.col("weights")).alias("r"), shares(F.col("all_support.institutions"), F.col("weights"), True).alias("i"), shares(F.col("all_support.count"), F.col("weights")).alias("c"))
    each = wide.select("*", F.element_at("ids", 1).alias("source_id"), F.posexplode("senses").alias("k", "sense"))
    new_id = tx.split_id(F.col("source_id"), F.col("k"))
    names = F.array_sort(F.array_distinct(F.filter(F.transform(F.array_append("names", F.col("sense.label")), tx.squeeze_ends), lambda n: n != "")))
    support = F.struct(F.get("r", F.col("k")).alias("records"), F.get("i", F.col("k")).alias("institutions"), F.get("c", F.col("k")).alias("count"))
    made = {"id": new_id, "ord": F.col("first_ord"), "level": F.col("level"), "canonical_label": tx.sense_label(F.col("canonical_label"), F.col("sense.label")), "parents": F.get("mapped", F.col("k")), "aliases": names, "support": support}
    fresh = each.select(*[made.get(c, F.lit(None)).cast(concepts.schema[c].dataType.simpleString()).alias(c) for c in concepts.columns])
    gone = done.select(F.explode("ids").alias("id"))
    out = concepts.join(gone, "id", "left_anti").select(*concepts.columns).unionByName(fresh)
    ops = wide.select(F.element_at("ids", 1).alias("source_id"), F.transform(F.sequence(F.lit(0), F.size("senses") - 1), lambda k: tx.split_id(F.element_at("ids", 1), k)).alias("new_ids"), F.lit("llm_disambiguation").alias("rule"), F.to_json(F.struct(F.col("sure").alias("confidence"), "senses")).alias("evidence"))
    ops = ops.select(F.sha2(F.concat_ws("|", F.col("source_id"), F.array_join("new_ids", "|")).cast("binary"), 256).alias("operation_id"), "*")
    return out, ops, deferred


def disambiguate(concepts: DataFrame, records: DataFrame | None, runner: Callable[[DataFrame], DataFrame], policy: DisambiguationPolicy = DisambiguationPolicy()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All steps. The runner gets the flagged collisions and gives label, answer (JSON)."""
    found = limited(windows(concepts, records, policy.window_size), policy) if records is not None else None
    flagged = collisions(concepts, found, policy).where("status = 'flagged'")
    return split(concepts, flagged, senses(runner(flagged), policy), policy)
