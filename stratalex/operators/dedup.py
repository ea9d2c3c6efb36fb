"""Concept deduplication: blocking, pair scores, components, merges.

Concepts: id, level, canonical_label, parents, aliases, support and, for repeated ids, ord (the last one stays)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import similarity as sm
from ..functions import text as tx
from ..functions.udfs import double_metaphone, jaro_winkler
from ..policies import DedupPolicy
from .components import components

PROBED = 3


def last_of_each(concepts: DataFrame) -> DataFrame:
    if "ord" not in concepts.columns:
        return concepts
    return concepts.withColumn("__n", F.row_number().over(W.partitionBy("id").orderBy(F.desc("ord")))).where("__n = 1").drop("__n")


def prefix_keys(concepts: DataFrame, policy: DedupPolicy) -> DataFrame:
    return concepts.select("id", F.lit("prefix").alias("strategy"), F.left(tx.comparable(F.col("canonical_label")), F.lit(policy.prefix_length)).alias("key")).where("key <> ''")


def phonetic_keys(concepts: DataFrame, policy: DedupPolicy) -> DataFrame:
    """Each distinct label is coded once."""
    coded = concepts.select("canonical_label").distinct().select("canonical_label", F.explode(double_metaphone(F.col("canonical_label"))).alias("key"))
    return concepts.select("id", "canonical_label").join(coded, "canonical_label").select("id", F.lit("phonetic").alias("strategy"), "key")


def acronym_keys(concepts: DataFrame, policy: DedupPolicy) -> DataFrame:
    """Of the label and up to three distinct aliases: the acronym itself, or the initials of two words or more."""
    own = F.filter(F.transform(F.coalesce("aliases", F.array().cast("array<string>")), lambda a, i: F.struct(F.lower(tx.squeeze_ends(a)).alias("low"), i.alias("i"), a.alias("a"))), lambda s: s["low"] != "")
    first = tx._let(own, lambda o: F.filter(o, lambda s: ~F.exists(o, lambda p: (p["low"] == s["low"]) & (p["i"] < s["i"]))))
    names = F.concat(F.array("canonical_label"), F.transform(F.slice(first, 1, PROBED), lambda s: s["a"]))
    each = concepts.select("id", F.explode(names).alias("name"))
    return each.select("id", F.lit("acronym").alias("strategy"), F.coalesce(tx.acronym_of(F.col("name")), tx.initials_key(F.col("name"))).alias("key")).where("key is not null")


def block_members(concepts: DataFrame, policy: DedupPolicy = DedupPolicy()) -> DataFrame:
    """strategy, block, id, place (from 1, by id). Blocks of more than max_block_size are cut into chunks; the chunk is part
    of the block's name, so that no block outgrows a task."""
    keys = prefix_keys(concepts, policy)
    if policy.phonetic_enabled:
        keys = keys.unionByName(phonetic_keys(concepts, policy))
    if policy.acronym_enabled:
        keys = keys.unionByName(acronym_keys(concepts, policy))
    keys = keys.distinct()
    of = W.partitionBy("strategy", "key")
    placed = keys.select("*", F.row_number().over(of.orderBy("id")).alias("n"), F.count("*").over(of).alias("size")).where("size > 1")
    chunk = F.floor((F.col("n") - 1) / policy.max_block_size)
    name = F.concat_ws(":", "strategy", "key")
    name = F.when(F.col("size") > policy.max_block_size, F.concat(name, F.lit("|"), F.lpad(chunk.cast("string"), 4, "0"))).otherwise(name)
    return placed.select("strategy", name.alias("block"), "id", (F.col("n") - chunk * policy.max_block_size).cast("int").alias("place"))


def block_metrics(members: DataFrame) -> DataFrame:
    sizes = members.groupBy("strategy", "block").agg(F.count("*").alias("size"))
    return sizes.groupBy("strategy").agg(F.count("*").alias("blocks"), F.max("size").alias("max_size"), F.avg("size").alias("avg_size"))


def parents_fit(policy: DedupPolicy) -> Column:
    if not policy.parent_context_strict:
        return F.lit(True)
    none = F.array().cast("array<string>")
    return (F.col("a_level") == 0) | (F.col("b_level") == 0) | F.arrays_overlap(F.coalesce("a_parents", none), F.coalesce("b_parents", none)) | F.lit(policy.cross_parent_merge_allowed)


def pairs(concepts: DataFrame, policy: DedupPolicy = DedupPolicy()) -> DataFrame:
    """block, a, b (a before b): the first max_comparisons pairs of each block in order of (a, b).

    The rank of a pair follows from the places of its members and the block's size, so no sort is needed for the cap."""
    members = block_members(concepts, policy)
    a = members.select("block", F.col("id").alias("a"), F.col("place").alias("i"))
    b = members.select("block", F.col("id").alias("b"), F.col("place").alias("j"))
    size = members.groupBy("block").agg(F.max("place").alias("size"))
    rank = (F.col("i") - 1) * F.col("size") - F.col("i") * (F.col("i") - 1) / 2 + F.col("j") - F.col("i")
    return a.join(size, "block").join(b, "block").where((F.col("i") < F.col("j")) & (rank <= policy.max_comparisons)).select("block", "a", "b")


def _abbreviation(policy: DedupPolicy) -> Column:
    """1.0 if a label or one of the first three aliases of one side abbreviates one of the other."""
    none = F.array().cast("array<string>")

    def names(side: str) -> Column:
        return F.concat(F.array(f"{side}_label"), F.slice(F.coalesce(f"{side}_aliases", none), 1, PROBED))

    return F.when(F.exists(names("a"), lambda x: F.exists(names("b"), lambda y: tx.abbreviates(x, y) == 1.0)), F.lit(1.0)).otherwise(F.lit(0.0))


def scored(concepts: DataFrame, policy: DedupPolicy = DedupPolicy()) -> DataFrame:
    """A row for each block and pair whose parents fit: block, a, b, features, score, driver, threshold, passed, probed_out.

    Each distinct pair is scored once. Labels meet Jaro-Winkler only where the abbreviation leaves them open."""
    met = pairs(concepts, policy)
    facts = concepts.select("id", "level", F.col("canonical_label").alias("label"), "parents", "aliases")

    def side(s: str) -> DataFrame:
        return facts.select(F.col("id").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("level", "label", "parents", "aliases")])

    once = met.select("a", "b").distinct().join(side("a"), "a").join(side("b"), "b").where(parents_fit(policy))
    limit = F.greatest(F.when(F.greatest("a_level", "b_level") <= 1, F.lit(policy.threshold_shallow)).otherwise(F.lit(policy.threshold_deep)), F.lit(policy.min_similarity))
    once = once.select("a", "b", "a_label", "b_label", limit.alias("threshold"), _abbreviation(policy).alias("abbrev"), tx.affix_hint(F.col("a_label"), F.col("b_label"), policy.heuristic_suffixes).alias("hint"), sm.token_jaccard(F.col("a_label"), F.col("b_label")).alias("tokens"))
    x, y = tx.comparable(F.col("a_label")), tx.comparable(F.col("b_label"))
    once = once.select("*", F.when(x == y, F.when(x == "", F.lit(0.0)).otherwise(F.lit(1.0))).alias("same"), x.alias("x"), y.alias("y"))
    once = once.select("*", F.coalesce("same", jaro_winkler(F.when(F.col("same").isNull(), F.col("x")), F.when(F.col("same").isNull(), F.col("y")))).alias("winkler"))
    early = F.lit(policy.early_stopping)
    no_winkler = early & (F.col("abbrev") >= 1)
    no_tokens = no_winkler | (early & (F.col("winkler") >= F.col("threshold")))
    jw, tokens = F.when(~no_winkler, F.col("winkler")), F.when(~no_tokens, F.col("tokens"))
    weighted = [("suffix_prefix_hint", F.when(F.col("hint") > 0, F.col("hint") * max(1.0, policy.abbrev_weight))), ("abbrev_score", F.col("abbrev") * policy.abbrev_weight), ("jaro_winkler", jw * policy.jaro_winkler_weight), ("token_jaccard", tokens * policy.jaccard_weight)]
    top = F.greatest(*[w for _, w in weighted])
    driver = F.coalesce(*[F.when(w == top, F.lit(n)) for n, w in weighted])
    once = once.select("a", "b", "threshold", "winkler", F.struct(F.col("abbrev").alias("abbrev_score"), jw.alias("jaro_winkler"), tokens.alias("token_jaccard"), F.col("hint").alias("suffix_prefix_hint")).alias("features"), F.least(F.lit(1.0), F.greatest("abbrev", jw, tokens)).alias("score"), driver.alias("driver"))
    probe = F.col("block").startswith("phonetic:") & (F.lit(policy.phonetic_probe_threshold) > 0) & (F.col("winkler") < policy.phonetic_probe_threshold)
    return met.join(once, ["a", "b"]).select("block", "a", "b", "features", "score", "driver", "threshold", probe.alias("probed_out"), (~probe & (F.col("score") >= F.col("threshold"))).alias("passed"))


def edges(scored_pairs: DataFrame) -> DataFrame:
    """One row for each linked pair, with the scores of its last block."""
    return scored_pairs.where("passed").groupBy("a", "b").agg(F.max_by(F.struct("block", "score", "threshold", "driver", "features"), "block").alias("e")).select("a", "b", "e.*")


def component_of(concepts: DataFrame, links: DataFrame) -> DataFrame:
    """id, component (its least id): concepts that have a link."""
    return components(links.select("a", "b")).select(F.col("node").alias("id"), F.col("root").alias("component"))


def mergeable(members: DataFrame, policy: DedupPolicy) -> DataFrame:
    """component, fits: every member below level 0 shares a parent with all the others, where that is asked for."""
    if not policy.parent_context_strict or policy.cross_parent_merge_allowed:
        return members.select("component").distinct().withColumn("fits", F.lit(True))
    deep = members.where("level > 0")
    sizes = members.groupBy("component").agg(F.count_if(F.col("level") > 0).alias("deep"))
    shared = deep.select("component", "id", F.explode(F.array_distinct("parents")).alias("parent")).groupBy("component", "parent").agg(F.count("*").alias("n")).groupBy("component").agg(F.max("n").alias("n"))
    return sizes.join(shared, "component", "left").select("component", ((F.col("deep") <= 1) | (F.coalesce("n", F.lit(0)) == F.col("deep"))).alias("fits"))


def merge(concepts: DataFrame, links: DataFrame, policy: DedupPolicy = DedupPolicy()) -> tuple[DataFrame, DataFrame]:
    """(survivors, merges): survivors like concepts; merges: winner, losers, rule and evidence of losers linked to the winner."""
    members = concepts.join(component_of(concepts, links), "id")
    members = members.join(mergeable(members, policy).where("fits").select("component"), "component")
    none = F.array().cast("array<string>")
    order = F.struct(-F.col("support.institutions"), F.length("canonical_label"), F.lower("canonical_label"), "id")
    best = members.groupBy("component").agg(
        F.min_by("id", order).alias("winner"),
        F.min_by("canonical_label", order).alias("winner_label"),
        F.array_sort(F.collect_set("id")).alias("ids"),
        F.array_distinct(F.flatten(F.collect_list(F.concat(F.array("canonical_label"), F.coalesce("aliases", none))))).alias("names"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("parents", none))))).alias("all_parents"),
        F.struct(F.sum("support.records").alias("records"), F.sum("support.institutions").alias("institutions"), F.sum("support.count").alias("count")).alias("all_support"),
    )
    best = best.select("component", "winner", F.array_except("ids", F.array("winner")).alias("losers"), F.array_sort(F.array_remove("names", F.col("winner_label"))).alias("all_names"), "all_parents", "all_support")
    other = best.select(F.explode("losers").alias("id"))
    joined = concepts.join(other, "id", "left_anti").join(best.select(F.col("winner").alias("id"), "all_names", "all_parents", "all_support"), "id", "left")
    new = {"aliases": F.coalesce("all_names", "aliases"), "parents": F.coalesce("all_parents", "parents"), "support": F.coalesce("all_support", "support")}
    survivors = joined.select(*[new.get(c, F.col(c)).alias(c) for c in concepts.columns])
    direct = best.select("winner", F.explode("losers").alias("loser"))
    near = direct.join(links, ((F.col("a") == F.col("winner")) & (F.col("b") == F.col("loser"))), "inner").unionByName(direct.join(links, ((F.col("b") == F.col("winner")) & (F.col("a") == F.col("loser"))), "inner"))
    told = near.groupBy("winner").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("loser", F.struct(F.round("score", 4).alias("score"), F.round("threshold", 4).alias("threshold"), "driver", "block", "features").alias("e")))))).alias("evidence"))
    merges = best.select("winner", "losers").join(told, "winner", "left")
    id_ = F.sha2(F.concat_ws("|", F.col("winner"), F.array_join("losers", "|")).cast("binary"), 256)
    return survivors, merges.select(id_.alias("operation_id"), F.array("winner").alias("winners"), "losers", F.lit(policy.merge_policy).alias("rule"), "evidence")


def remap_parents(concepts: DataFrame, merges: DataFrame) -> DataFrame:
    """Children of merged concepts point to the winner; each parent once, in order."""
    new = merges.select(F.explode("losers").alias("old"), F.element_at("winners", 1).alias("new"))
    each = concepts.select("id", F.posexplode("parents").alias("at", "old")).join(new, "old", "left").select("id", "at", F.coalesce("new", "old").alias("p"))
    found = each.groupBy("id").agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("at", "p"))), lambda s: s["p"])).alias("__parents"))
    return concepts.join(found, "id", "left").select(*[F.coalesce("__parents", "parents").alias("parents") if c == "parents" else F.col(c) for c in concepts.columns])


def statistics(concepts: DataFrame, scored_pairs: DataFrame, links: DataFrame) -> DataFrame:
    counts = scored_pairs.agg(F.count_if(~F.col("probed_out")).alias("pairs_compared"), F.count_if("passed").alias("edges_kept"), F.count_if(~F.col("probed_out") & ~F.col("passed")).alias("below_threshold"), F.count_if("probed_out").alias("phonetic_probe_filtered"))
    return concepts.agg(F.count("*").alias("total_concepts"), F.count_distinct("id").alias("unique_concepts")).crossJoin(counts).crossJoin(links.agg(F.count("*").alias("links")))
