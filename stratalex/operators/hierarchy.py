"""Hierarchy assembly: concepts enter level by level; those whose parents are missing or wrong become orphans.

Concepts: id, level, canonical_label, parents. There are four levels, so a fixed number of joins replaces recursion."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..policies import HierarchyPolicy
from ..sources.shared import cut

LEVELS = (0, 1, 2, 3)


@dataclass
class Hierarchy:
    nodes: DataFrame  # the concepts inserted, placeholders included
    edges: DataFrame  # parent, child
    orphans: DataFrame  # concept_id, level, missing_parents, strategy, detail


def _problem(policy: HierarchyPolicy) -> Column:
    """Why a concept whose parents are all there may not enter; null if it may."""
    n, level = F.size("parents"), F.col("level")
    single = ~F.col("id").isin(*policy.multi_parent_exceptions) if policy.multi_parent_exceptions else F.lit(True)
    checks = [
        (F.col("copy") > 1, "the id is there already"),
        (~level.between(0, 3), "the level is outside 0 to 3"),
        (F.exists("parent_levels", lambda p: p >= level), "a parent is not above its child"),
        (F.exists("parent_levels", lambda p: level - p != 1) if policy.strict_levels and not policy.allow_shortcuts else F.lit(False), "an edge skips a level"),
        ((n > 1) & single if policy.enforce_unique_paths else F.lit(False), "several parents"),
        ((level == 0) & (n > 0), "a root has parents"),
        ((level > 0) & (n == 0), "no parent"),
    ]
    return F.coalesce(*[F.when(c, F.lit(why)) for c, why in checks])


def assemble(concepts: DataFrame, policy: HierarchyPolicy = HierarchyPolicy()) -> Hierarchy:
    """Levels 0 to 3 in turn, ids in order within a level. Parents are looked up among the nodes inserted so far, and among
    the same level's for concepts that (wrongly) point there: such an edge is an error, not a missing parent."""
    none = F.array().cast("array<string>")
    rows = concepts.select(*[F.coalesce("parents", none).alias("parents") if c == "parents" else F.col(c) for c in concepts.columns])
    rows = rows.withColumn("copy", F.row_number().over(W.partitionBy("id").orderBy("level", *(["ord"] if "ord" in rows.columns else []))))
    out_of_range = rows.where(~F.col("level").between(0, 3))
    names = concepts.columns
    inserted = orphans = None
    placeholders: set[int] = set()

    def orphan(df: DataFrame, missing: Column, strategy: str, detail: Column) -> DataFrame:
        return df.select(F.col("id").alias("concept_id"), "level", missing.alias("missing_parents"), F.lit(strategy).alias("strategy"), detail.alias("detail"))

    def more(old: DataFrame | None, new: DataFrame) -> DataFrame:
        return new if old is None else old.unionByName(new)

    for level in LEVELS:
        own = rows.where(F.col("level") == level)
        known = None if inserted is None else inserted.select(F.col("id").alias("parent"), F.col("level").alias("parent_level"))
        each = own.select("id", "copy", F.explode("parents").alias("parent")).distinct()
        each = each.withColumn("parent_level", F.lit(None).cast("int")) if known is None else each.join(known, "parent", "left")
        met = each.groupBy("id", "copy").agg(F.collect_set(F.when(F.col("parent_level").isNull(), F.col("parent"))).alias("gone"), F.array_compact(F.collect_list("parent_level")).alias("parent_levels"))
        wide = own.join(met, ["id", "copy"], "left").select(*own.columns, F.array_sort(F.coalesce("gone", none)).alias("gone"), F.coalesce("parent_levels", F.array().cast("array<int>")).alias("parent_levels"))
        lost = F.size("gone") > 0
        orphans = more(orphans, orphan(wide.where(lost), F.col("gone"), policy.orphan_strategy, F.lit("missing-parent")))
        unique = F.array_distinct("parents")
        ready = wide.where(~lost).withColumn("parents", unique)
        if policy.orphan_strategy == "attach_placeholder" and level > 0:
            holder = f"{policy.placeholder_prefix}level{level - 1}"
            attached = wide.where(lost).withColumn("parents", F.array_append(F.array_except(unique, F.col("gone")), F.lit(holder))).withColumn("parent_levels", F.array_append("parent_levels", F.lit(level - 1)))
            if attached.limit(1).count():
                for k in range(level):
                    if k not in placeholders:
                        placeholders.add(k)
                        parents = none if k == 0 else F.array(F.lit(f"{policy.placeholder_prefix}level{k - 1}"))
                        made = {"id": F.lit(f"{policy.placeholder_prefix}level{k}"), "level": F.lit(k), "canonical_label": F.lit(f"Placeholder Level {k}"), "parents": parents}
                        one = concepts.sparkSession.range(1).select(*[made.get(c, F.lit(None)).cast(concepts.schema[c].dataType.simpleString()).alias(c) for c in names])
                        inserted = more(inserted, one)
                ready = ready.unionByName(attached)
        judged = ready.withColumn("problem", _problem(policy))
        orphans = more(orphans, orphan(judged.where("problem is not null"), F.col("parents"), "error", F.col("problem")))
        inserted = cut(more(inserted, judged.where("problem is null").select(*names)), f"level-{level}")
    orphans = more(orphans, orphan(out_of_range, F.col("parents"), "error", F.lit("the level is outside 0 to 3")))
    if policy.max_nodes is not None:
        inserted, full = _bounded(inserted, policy.max_nodes)
        orphans = orphans if full is None else orphans.unionByName(orphan(full, F.col("parents"), "error", F.lit("the hierarchy is full")))
    return Hierarchy(inserted, edges_of(inserted), orphans)


def _bounded(nodes: DataFrame, most: int) -> tuple[DataFrame, DataFrame | None]:
    """The first `most` nodes by level and id, and the others (None if there are none). Only the level where the bound falls is ordered."""
    counts = {r["level"]: r["count"] for r in nodes.groupBy("level").count().collect()}
    room = most
    for level in LEVELS:
        if counts.get(level, 0) > room:
            here = nodes.where(F.col("level") == level)
            first = here.orderBy("id").limit(room).select("id")
            kept = nodes.where(F.col("level") < level).unionAll(here.join(first, "id", "left_semi"))
            return kept, nodes.where(F.col("level") > level).unionAll(here.join(first, "id", "left_anti"))
        room -= counts.get(level, 0)
    return nodes, None


def edges_of(nodes: DataFrame) -> DataFrame:
    return nodes.select(F.explode("parents").alias("parent"), F.col("id").alias("child"))


def statistics(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: node_count, edge_count, nodes by level, max_out_degree, max_in_degree."""
    counts = nodes.agg(F.count("*").alias("node_count"), *[F.count_if(F.col("level") == k).alias(f"level_{k}") for k in LEVELS])
    out = edges.groupBy("parent").count().agg(F.coalesce(F.max("count"), F.lit(0)).alias("max_out_degree"))
    into = edges.groupBy("child").count().agg(F.coalesce(F.max("count"), F.lit(0)).alias("max_in_degree"), F.coalesce(F.sum("count"), F.lit(0)).alias("edge_count"))
    return counts.crossJoin(out).crossJoin(into)  # one row each


def violations(nodes: DataFrame, policy: HierarchyPolicy = HierarchyPolicy()) -> DataFrame:
    """code, concept_id, detail of every broken invariant."""
    n = F.size(F.coalesce("parents", F.array().cast("array<string>")))
    single = ~F.col("id").isin(*policy.multi_parent_exceptions) if policy.multi_parent_exceptions else F.lit(True)
    checks = [
        ("invalid-level", ~F.col("level").between(0, 3), "the level is outside 0 to 3"),
        ("root-has-parents", (F.col("level") == 0) & (n > 0), "a root must not have parents"),
        ("missing-parent", (F.col("level") > 0) & (n == 0), "a concept below the roots needs a parent"),
        ("non-unique-path", (F.col("level") > 0) & ((n == 0) | ((n > 1) & single)) & F.lit(policy.enforce_unique_paths), "a concept must have one path from a root"),
    ]
    found = F.filter(F.array(*[F.when(c, F.struct(F.lit(code).alias("code"), F.lit(why).alias("detail"))) for code, c, why in checks]), lambda v: v.isNotNull())
    return nodes.select(F.explode(found).alias("v"), F.col("id").alias("concept_id")).select("v.code", "concept_id", "v.detail")


# What to do about a kind of violation.
REPAIRS = {"missing-parent": "Attach placeholder parents or quarantine concepts without valid parents.", "non-unique-path": "Review merges that gave a concept several parents.", "invalid-level": "Let promotion emit levels 0 to 3 only."}


def cyclic(edges: DataFrame) -> DataFrame:
    """Edges that lie on or below a cycle: what is left when nodes without parents are peeled off, round by round, until
    nothing more goes; there are as many rounds as the longest path has edges."""
    left = cut(edges.select("parent", "child").distinct(), "peel")
    while True:
        rest = cut(left.join(left.select(F.col("child").alias("parent")).distinct(), "parent", "left_semi"), "peel")
        if rest.count() == left.count():
            return rest
        left = rest


def lineages(nodes: DataFrame) -> DataFrame:
    """id, level, path (ids from the root down, joined by ' > '): one row for each path, by joins down the levels."""
    paths = nodes.where("level = 0").select("id", "level", F.col("id").alias("path"))
    every = paths
    for level in LEVELS[1:]:
        own = nodes.where(F.col("level") == level).select("id", "level", F.explode("parents").alias("parent"))
        above = paths.select(F.col("id").alias("parent"), F.col("path").alias("above"))
        paths = own.join(above, "parent").select("id", "level", F.concat_ws(" > ", "above", "id").alias("path"))
        every = every.unionAll(paths)
    return every


def report(nodes: DataFrame, edges: DataFrame, policy: HierarchyPolicy = HierarchyPolicy(), first: int = 100) -> dict:
    """passed, counts of violations by code with the first of them, orphans, statistics and repair hints; all of bounded size."""
    broken = violations(nodes, policy)
    counts = {r["code"]: r["count"] for r in broken.groupBy("code").count().collect()}
    cycle = cyclic(edges).count()
    if cycle:
        counts["cycle-detected"] = cycle
    orphans = nodes.where((F.col("level") > 0) & (F.size("parents") == 0)).count()
    return {
        "passed": not counts and not orphans,
        "violations": counts,
        "examples": [r.asDict() for r in broken.orderBy("code", "concept_id").limit(first).collect()],
        "orphans": orphans,
        "statistics": statistics(nodes, edges).first().asDict(),
        "acyclic": not cycle,
        "repairs": [REPAIRS[c] for c in sorted(counts) if c in REPAIRS],
    }


def adjacency(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """id, children (sorted)."""
    of = edges.groupBy(F.col("parent").alias("id")).agg(F.array_sort(F.collect_set("child")).alias("children"))
    return nodes.select("id").join(of, "id", "left").select("id", F.coalesce("children", F.array().cast("array<string>")).alias("children"))


def dot_lines(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Graphviz lines of the nodes and edges, without the frame."""
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('\\"')), F.lit('"'))
    labels = nodes.select(F.concat(F.lit("  "), quoted(F.col("id")), F.lit(" [label="), quoted(F.col("canonical_label")), F.lit("];")).alias("line"))
    return labels.unionAll(edges.select(F.concat(F.lit("  "), quoted(F.col("parent")), F.lit(" -> "), quoted(F.col("child")), F.lit(";")).alias("line")))
