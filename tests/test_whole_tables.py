"""Queries and operators take every row, against brute force."""

import difflib

import duckdb
import pytest
from pyspark.sql import functions as F

from stratalex import queries
from stratalex.operators import extract, hierarchy
from stratalex.oracles import ORACLES
from stratalex.policies import HierarchyPolicy


def test_combined_similarity_takes_every_part(spark, tmp_path):
    names = ["steel bolt", "steel bolt ring", "copper ring", "copper ring", "brass ring steel"]
    rows = [(k, names[i % 5], "ECONOMY" if i % 2 else "SMALL", f"Brand#{i % 3}") for i, k in enumerate([*range(4), *range(1998, 2003), *range(90_000, 90_007)])]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_type string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")

    def words(r):
        return set(" ".join(r[1:]).lower().replace("#", " ").split())

    at = {r[0]: words(r) for r in rows}
    want = {k: round(len(x & at[k + 1]) / len(x | at[k + 1]), 6) for k, x in at.items() if k + 1 in at}
    found = {r["p_partkey"]: r["score"] for r in queries.combined_similarity(spark, str(tmp_path)).collect()}
    assert found == want and max(found) > 2000


@pytest.mark.parametrize("most", [3, 7, 50_000])
def test_fuzzy_parents_in_blocks(spark, monkeypatch, most):
    """Whatever fits in a block, the three closest keys of shallower levels win."""
    monkeypatch.setattr(extract, "MOST_KEYS", most)
    keys = [(f"mechanical enginering {c}", f"P{c}{level}", level, 0) for level in (0, 1, 2) for c in "abcdefg"[level * 2 : level * 2 + 4]]
    keys += [("mechanical engineering xx", "deep1", 2, 0), ("mechanical engineering xy", "deep2", 2, 0), ("mechanical engineering xz", "deep3", 3, 0)]
    parents = spark.createDataFrame(keys, "key string, parent_id string, parent_level int, ord int")
    asked = [("mechanical engineering x", level) for level in (1, 2, 3)] + [("quite another thing", 2), ("mechanical enginering a", 1)]
    anchors = spark.createDataFrame(asked, "anchor string, level int")
    forms = {(r["anchor"], r["level"], r["rank"]): r["form"] for r in extract.anchor_forms(anchors).collect()}
    want = {}
    for anchor, level in asked:
        allowed = sorted({k for k, _, at, _ in keys if at < level})
        found = []
        exact = [p for (a, at, _), f in sorted(forms.items()) if (a, at) == (anchor, level) for k, p, pl, _ in sorted(keys, key=lambda x: x[1]) if k == f and pl < level]
        for (a, at, _), f in sorted(forms.items()):
            for k in difflib.get_close_matches(f, allowed, n=3, cutoff=0.86) if (a, at) == (anchor, level) and not exact else []:
                found += [p for key, p, pl, _ in sorted(keys, key=lambda x: x[1]) if key == k and pl < level]
        want[anchor, level] = list(dict.fromkeys(exact or found)) or [f"UNRESOLVED:{anchor}"]
    got = {(r["anchor"], r["level"]): list(r["parent_ids"]) for r in extract.resolve(anchors, parents).collect()}
    assert got == want and not got["mechanical engineering x", 1][0].startswith("UNRESOLVED")


@pytest.mark.parametrize("name", ["hierarchy_adjacency", "hierarchy_edges", "hierarchy_orphans", "hierarchy_paths", "hierarchy_placeholders", "hierarchy_stats"])
def test_hierarchies_take_every_concept(spark, tmp_path, name):
    """More concepts than the policy's default bound."""
    made = {
        "region": spark.range(3).select(F.col("id").cast("int").alias("r_regionkey"), F.col("id").cast("string").alias("r_name")),
        "nation": spark.range(9).select(F.col("id").cast("int").alias("n_nationkey"), F.col("id").cast("string").alias("n_name"), (F.col("id") % 3).cast("int").alias("n_regionkey")),
        "supplier": spark.range(700).select(F.col("id").alias("s_suppkey"), F.col("id").cast("string").alias("s_name"), (F.col("id") % 9).cast("int").alias("s_nationkey")),
        "customer": spark.range(110_000).select(F.col("id").alias("c_custkey"), F.col("id").cast("string").alias("c_name")),
    }
    connection = duckdb.connect()
    for table, rows in made.items():
        rows.coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
        connection.execute(f"create view {table} as select * from '{tmp_path}/{table}.parquet/*.parquet'")
    want = connection.execute(ORACLES[name]).fetchall()
    columns = [c[0] for c in connection.description]
    assert sorted(tuple(r[c] for c in columns) for r in queries.QUERIES[name](spark, str(tmp_path)).collect()) == sorted(want)


def test_bounded_hierarchy_orders_one_level(spark):
    rows = [("r", 0, "r", []), *[(f"n{k}", 1, "n", ["r"]) for k in range(5)], ("s", 2, "s", ["n0"])]
    concepts = spark.createDataFrame(rows, "id string, level int, canonical_label string, parents array<string>")
    for most, ids in ((3, {"r", "n0", "n1"}), (6, {"r", *[f"n{k}" for k in range(5)]}), (7, {r[0] for r in rows}), (None, {r[0] for r in rows})):
        h = hierarchy.assemble(concepts, HierarchyPolicy(max_nodes=most))
        assert {r["id"] for r in h.nodes.collect()} == ids
        assert {(r["concept_id"], r["detail"]) for r in h.orphans.collect()} == {(r[0], "the hierarchy is full") for r in rows if r[0] not in ids}
