"""The pipeline's near copies against exact Jaccard similarity of all pairs."""

import random

import corpus_pipeline

from stratalex.llm import shingles
from stratalex.llm.base import table


def brute(rows, least=0.8):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x == y or (min(len(x), len(y)) >= least * max(len(x), len(y)) and len(x & y) >= least * len(x | y)):
                root[find(i)] = find(j)
    groups = {}
    for i, (k, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(k)
    return {min(g) for g in groups.values()}


def kept(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"] for r in corpus_pipeline.STAGES[1][1](spark, docs, "").select("doc_id").collect()}


def test_edited_copies_go_and_clean_documents_stay(spark):
    rows, at = [], 0
    for group in range(12):
        words = [f"w{group}x{i}" for i in range(60 + 40 * group)]
        for edit in range(6):  # each edit changes up to five shingles
            some = list(words)
            for e in range(edit):
                some[(e * 17 + group) % len(some)] = f"edit{group}e{e}"
            rows.append((at, " ".join(some)))
            at += 1
    want = brute(rows)
    assert kept(spark, rows) == want and 12 <= len(want) < len(rows)


def test_chain_of_edits_is_one_group(spark):
    """Neighbours are similar, ends are not: links other than those to the first or last point count."""
    words = [f"w{i}" for i in range(400)]
    rows = [(at, " ".join(words[at * 12 : at * 12 + 200])) for at in range(16)]
    assert kept(spark, rows) == brute(rows) == {0}


def test_near_misses_of_one_text(spark):
    """Copies with few or many edits of their own: some pairs are similar, more share keys only."""
    base, rng, rows = [f"w{i}" for i in range(300)], random.Random(7), []
    for at in range(60):
        some = list(base)
        for i in rng.sample(range(300), (13, 9, 5, 3)[at % 4] if at > 2 else 14):
            some[i] = f"edit{at}at{i}" if at % 3 else f"edit{i}"
        rows.append((at, " ".join(some)))
    want = brute(rows)
    assert kept(spark, rows) == want and 1 < len(want) < len(rows)


def test_parities_bound_the_difference():
    rng = random.Random(3)
    for n in (0, 1, 40, 900):
        words = [f"w{rng.randrange(4 * n + 1)}" for _ in range(n)]
        texts = [" ".join(words), " ".join(w if rng.random() < 0.9 else "other" for w in words)]
        (x, y), (p, q) = shingles._sets(texts, 5)
        unlike = sum(((a ^ b) & (1 << 64) - 1).bit_count() for a, b in zip(p, q, strict=True))
        assert len(p) == shingles.PARITIES and unlike <= len(set(x) ^ set(y)) and (unlike - len(set(x) ^ set(y))) % 2 == 0


def test_tables(spark, data):
    rows = [tuple(r) for r in table(spark, data, "documents").select("doc_id", "text").collect()]
    assert kept(spark, rows) == brute(rows)


def test_copies_without_ids_or_with_one_id(spark):
    """A text is found by one of its ids, which may be null or stand for several texts."""
    words = [f"w{i}" for i in range(120)]
    near, nearer = " ".join([*words[:-1], "x"]), " ".join([*words[:-1], "y"])
    docs = spark.createDataFrame([(None, near)] * 3 + [(None, nearer)] * 2 + [(7, " ".join(words))] * 2 + [(7, near), (7, "another text")], "doc_id long, text string")
    out = [tuple(r) for r in shingles.drop_similar(docs).collect()]
    assert len(out) == 2 and (7, "another text") in out and all(k == 7 for k, _ in out)


def test_odd_rows(spark, clashing):
    out = shingles.drop_similar(clashing)
    assert out.columns == clashing.columns and out.dtypes == clashing.dtypes and 0 < out.count() < clashing.count()
    assert shingles.drop_similar(clashing.limit(0)).count() == 0


def test_trees_of_fingerprints_give_candidates(spark):
    """The forest joins whatever chains of two bits join, and every pair of it lies in one such chain."""
    rng = random.Random(5)
    base = [rng.getrandbits(63) for _ in range(40)]
    prints = [x ^ sum(1 << b for b in rng.sample(range(63), rng.choice([0, 0, 1, 2, 3]))) for x in base for _ in range(6)]
    points = list(enumerate(prints))
    found = shingles.tree_pairs(spark.createDataFrame(points, "point long, fingerprint long")).collect()

    def roots(pairs):
        root = list(range(len(points)))
        for _ in points:
            for a, b in pairs:
                root[a] = root[b] = min(root[a], root[b])
        return root

    near = [(a, b) for a, x in points for b, y in points if a < b and (x ^ y).bit_count() <= 2]
    assert near and roots([(r["a"], r["b"]) for r in found]) == roots(near)


def test_near_copies_meet_by_fingerprints(spark, monkeypatch):
    """The stage asks the trees, and confirms what they give on the sets."""
    asked = []
    trees = shingles.near_links
    monkeypatch.setattr(shingles, "near_links", lambda points, radius: asked.append(radius) or trees(points, radius))
    words = [f"w{k}" for k in range(300)]
    rows = [(0, " ".join(words)), (1, " ".join([*words[:299], "other"])), (2, " ".join(words[::-1])), (3, "")]
    assert kept(spark, rows) == brute(rows) == {0, 2, 3} and asked == [shingles.RADIUS]
