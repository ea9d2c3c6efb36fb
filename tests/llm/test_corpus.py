"""Licence scan, language-model scores and sharding against plain Python."""

import math
import os
import re
import zlib
from collections import Counter

import pytest
from llm.test_contracts import LOWER, WORD, key, same, texts

from stratalex.llm import licences, ngrams, queries, shards
from stratalex.llm.base import table


shards_class = shards.ShardStore


def brute_lm(rows, order=3, least=1, backoff=0.4):
    split = [(i, WORD.findall((t or "").translate(LOWER))) for i, t in rows]
    grams = lambda ws: Counter(tuple(ws[k - n : k]) for n in range(1, order + 1) for k in range(n, len(ws) + 1))
    every, total = Counter(), sum(len(ws) for _, ws in split)
    for _, ws in split:
        every.update(grams(ws))
    for i, ws in split:
        own = grams(ws)
        others, score, backed = max(total - len(ws), 1), 0.0, 0
        for k in range(1, len(ws) + 1):
            top = min(k, order)
            for n in range(top, 0, -1):
                g = tuple(ws[k - n : k])
                met = every[g] - own[g]
                if n == 1 or met >= least:
                    score += math.log(max(met, 1) / others if n == 1 else met / (every[g[:-1]] - own[g[:-1]])) + (top - n) * math.log(backoff)
                    backed += n < top
                    break
        yield i, len(ws), backed, score


def close(df, expected):
    got = sorted(df.collect(), key=lambda r: key((r["doc_id"], r["n_words"], round(r["log_score"], 3))))
    want = sorted(expected, key=lambda r: key((r[0], r[1], round(r[3], 3))))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert (g["doc_id"], g["n_words"], g["n_backoff"]) == w[:3] and abs(g["log_score"] - w[3]) < 1e-3
        assert g["mean_log"] is None if not w[1] else abs(g["mean_log"] - w[3] / w[1]) < 1e-5


def test_op8_brute_force(spark, data):
    close(queries.op8_ngrams(spark, data), list(brute_lm(texts(table(spark, data, "documents")))))


@pytest.mark.parametrize("order, least, chunk_words", [(3, 1, 1 << 21), (4, 1, 50), (2, 2, 1000), (1, 1, 7), (5, 3, 300)])
def test_op8_odd_rows(spark, odd, clashing, order, least, chunk_words):
    close(ngrams.score(clashing, order=order, least=least, chunk_words=chunk_words), list(brute_lm(texts(odd), order, least)))


def test_op8_without_words(spark, odd):
    assert ngrams.score(odd.limit(0)).count() == 0
    blank = odd.where("doc_id in (0, 1, 2, 3)")  # no words, and single words only
    close(ngrams.score(blank), list(brute_lm(texts(blank))))
    assert [r["mean_log"] for r in ngrams.score(odd.where("doc_id = 0")).collect()] == [None]


def test_op8_joins_counts_to_occurrences(spark, data):
    text = queries.op8_ngrams(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert re.search("SortMergeJoin|HashJoin", text)


def test_op8_packs_told_rows_whole(monkeypatch):
    """Whatever is packed together, every told row comes back once, with its chunk."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    key, chunk, total = rng.integers(-(1 << 63), 1 << 63, 1000), rng.integers(0, 5, 1000), rng.integers(1, 1 << 40, 1000)
    batches = [pa.RecordBatch.from_arrays([pa.array(x[k : k + 130]) for x in (chunk, key, total)], names=["chunk", "key", "total"]) for k in range(0, 1000, 130)]
    for most in (1, 300, 1 << 20):
        monkeypatch.setattr(ngrams, "PACK", most)
        packed = pa.Table.from_batches(ngrams._pack(iter(batches)))
        found = []
        for c, k, t in zip(*(packed.column(n).to_pylist() for n in ("chunk", "keys", "totals"))):
            found += [(c, a, b) for a, b in zip(ngrams.unpack_keys(k).view(np.int64).tolist(), ngrams.from_planes(t, np.int64).tolist())]
        assert sorted(found) == sorted(zip(chunk.tolist(), key.tolist(), total.tolist()))
    assert not list(ngrams._pack(iter([batches[0].slice(0, 0)])))


def test_op8_tells_chunks_without_keys(spark, monkeypatch):
    """What comes back lies in the order of parts and keys, so that packs need no keys; a lost, doubled or foreign pack is found."""
    import numpy as np
    import pyarrow as pa
    from pyspark.sql import functions as F

    rng = np.random.default_rng(5)
    keys = np.unique(np.concatenate([rng.integers(-(1 << 63), 1 << 63, 3000), [0, -1, 1 << 62]]).view(np.uint64))
    for parts in (1, 7, 70_000):
        dealt = spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "key long").select(F.pmod(F.hash("key"), F.lit(parts))).collect()
        assert ngrams.part_of(keys, parts).tolist() == [r[0] for r in dealt]
    key, chunk = np.concatenate([keys, keys[::2]]).view(np.int64), np.repeat([4, 9], [len(keys), len(keys[::2])])
    total = rng.integers(0, 1 << 40, len(key))
    mixed = rng.permutation(len(key))
    batches = [pa.RecordBatch.from_arrays([pa.array(x[mixed[k : k + 130]]) for x in (chunk, key, total)], names=["chunk", "key", "total"]) for k in range(0, len(key), 130)]
    packed = pa.Table.from_batches(ngrams._pack(iter(batches), 7))
    assert "keys" not in packed.column_names and len(packed) == 14
    whole = packed.append_column("longest", pa.array([2] * len(packed)))
    empty = (np.zeros(1, np.uint32).tobytes(), b"", b"")
    for number, own in ((4, keys), (9, keys[::2])):
        told = whole.filter(pa.array([c == number for c in whole.column("chunk").to_pylist()]))
        order = rng.permutation(len(own))
        assert (ngrams._Chunk(*empty, told, 7).elsewhere(2, own[order]) == total[chunk == number][order]).all()
        for wrong in (told.slice(1), whole):
            with pytest.raises(ValueError):
                ngrams._Chunk(*empty, wrong, 7).elsewhere(2, own)


def test_op8_words_are_those_of_bytes():
    import pyarrow as pa

    texts = [None, "", " ", " a\x0bB  c\x0c", "É\x85İ \xa0K", "\x1c \x1f\x00 z\r\n", "\U0001f600 Q\tq"]
    want = [t.encode().lower().split() if t else [] for t in texts]
    for first in (0, 2):
        found, counts = ngrams._words(pa.array(texts).slice(first))
        assert counts.tolist() == [len(w) for w in want[first:]] and found.to_pylist() == [x for w in want[first:] for x in w]


def brute_units(body):
    yield from ((0, u) for u in re.split(licences.UNIT, body))
    yield from ((1, u) for u in re.split(licences.BLANK, body) if len(re.split(licences.WORD, u)) <= licences.PARAGRAPH)
    lines = body.split("\n")
    for k in range(0, len(lines) if len(lines) > 1 else 0, licences.STRIDE):
        some = lines[k : k + licences.WINDOW]
        if all(len(x) <= licences.LINE for x in some):
            yield 2, "\n".join(some)


def brute_licences(rows):
    """rows: (doc_id, text, path)"""
    bodies = [(t or "").translate(LOWER) for _, t, _ in rows]
    split = lambda x: [t for t in re.split(r"[^a-z0-9]+", x) if t]
    df = Counter(t for b in bodies for t in set(split(b)))
    idf = lambda t: math.log((1 + len(rows)) / (1 + df[t])) + 1
    vectors = []
    for name, x in licences.TEMPLATES:
        v = {t: n * idf(t) for t, n in Counter(split(x.lower())).items()}
        norm = math.sqrt(sum(a * a for a in v.values()))
        vectors.append((name, {t: a / norm for t, a in v.items()}))
    own, files = [], {}
    for (_, _, path), body in zip(rows, bodies):
        best, said = None, [0, 0, 0]
        for kind, unit in brute_units(body):
            u = {t: n * idf(t) for t, n in Counter(split(unit)).items()}
            norm = math.sqrt(sum(a * a for a in u.values()))
            if norm:
                top = min((-round(sum(u.get(t, 0) * a for t, a in v.items()), 9), name) for name, v in vectors)
                cosine = round(-top[0] / norm, 9)
                if cosine >= licences.THRESHOLD:
                    said[kind] += len(split(unit))
                    found = (top[1] == licences.RESERVED, -cosine, top[1])
                    best = min(best, found) if best else found
        best = best and best[1:]
        folder = path.rpartition("/")[0] if path is not None else None
        is_file = best and (2 * max(said[:2]) >= len(split(body)) or bool(path and re.match(licences.FILE_NAMES, path.rpartition("/")[2])))
        own.append((best, folder, is_file))
        if is_file and folder is not None:
            files[folder] = min(files.get(folder, best), best)
    for (i, _, _), (best, folder, is_file) in zip(rows, own):
        if best:
            yield i, best[1], round(-best[0], 6), "file" if is_file else "header", folder if is_file else None
            continue
        up = [f for f in files if folder is not None and (f == folder or f == "" or folder.startswith(f + "/"))]
        near = max(up, key=len, default=None)
        yield (i, files[near][1], round(-files[near][0], 6), "inherited", near) if near is not None else (i, None, None, "none", None)


def test_op6_brute_force(spark, data):
    rows = [(r["doc_id"], r["text"], f"{r['source']}/{r['lang']}/{r['doc_id']}") for r in table(spark, data, "documents").collect()]
    want = list(brute_licences(rows))
    assert {w[1] for w in want} >= {"MIT", "Apache-2.0"}
    got = {r["doc_id"]: r for r in queries.op6_licences(spark, data).collect()}
    assert len(got) == len(want)
    for w in want:
        g = got[w[0]]
        assert (g["licence"], g["origin"], g["directory"]) == (w[1], w[3], w[4]) and (w[2] is None or abs(g["cosine"] - w[2]) < 2e-6)


MIT_FILE = """MIT License

Copyright (c) 2020 Example Corporation

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
GPL_HEADER = """# tool.py does things
# Copyright 2021 A. Writer
#
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
import os
import sys
""" + "\n".join(f"value_{k} = call(value_{k + 1}, {k})" for k in range(40))
BSD_FILE = "Copyright (c) 2019, Someone. All rights reserved.\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:"


@pytest.mark.parametrize("broadcast_terms", [1 << 18, 0])
def test_op6_paths_and_odd_rows(spark, odd, clashing, broadcast_terms):
    mit, apache = "Released under the MIT License.", "Some words of prose that go on and on.\nLicensed under the Apache License, Version 2.0."
    rows = [(1, mit, "LICENSE"), (2, "print one", "src/a.py"), (3, apache, "src/b.py"), (4, apache, "src/lib/COPYING"), (5, "code", "src/lib/x/y.py"), (6, None, "src/lib2/y.py"), (7, "x", None), (7, "x", None), (8, "", "z"), (None, "All rights reserved", "q/r")]
    rows += [(9, MIT_FILE, "vendor/mit/LICENSE.txt"), (10, "int main;", "vendor/mit/src/main.c"), (11, GPL_HEADER, "tools/tool.py"), (12, BSD_FILE, "vendor/bsd/LICENSE"), (13, "SPDX-License-Identifier: MPL-2.0", "w/x.rs"), (14, "This project is licensed under the MIT License", "w/README"), (15, "We went to the market and bought bread, under a grey sky, with permission.", "w/story")]
    df = spark.createDataFrame(rows, "doc_id int, text string, path string")
    from pyspark.sql import functions as F

    want = [(w[0], w[1], w[3], w[4]) for w in brute_licences(rows)]
    same(licences.scan(df, path=F.col("path"), broadcast_terms=broadcast_terms).drop("cosine"), want)
    found = {w[0]: w[1:3] for w in want}
    assert found[9] == ("MIT", "file") and found[10] == ("MIT", "inherited") and found[11] == ("GPL-3.0", "header") and found[12] == ("BSD-3-Clause", "file")
    assert found[13][0] == "MPL-2.0" and found[14][0] == "MIT" and found[15] == ("MIT", "inherited")
    if broadcast_terms:
        same(licences.scan(clashing, path=clashing["label"]).drop("cosine"), [(w[0], w[1], w[3], w[4]) for w in brute_licences([(i, t, "x") for i, t in texts(odd)])])
        assert licences.scan(odd).count() == odd.count() and licences.scan(odd.limit(0)).count() == 0


def test_op6_long_paragraphs_and_lines(spark):
    """A notice that only a paragraph of over 400 words holds, and one that only a window of lines of over 200 characters holds."""
    permission = next(x for name, x in licences.TEMPLATES if name == "MIT" and "sublicense" in x)
    words = re.split(licences.WORD, permission.lower())[:-1]
    scattered = " ".join(f"{w}." for w in words * 6)
    lines = [" ".join(words[k :: 6] * 5) for k in range(6)]
    filler = [" ".join(f"word{k}x{n}" for n in range(120)) for k in range(24)]
    wrapped = "\n".join([*filler[:12], *lines, *filler[12:]])
    assert len(words) * 6 > 400 and min(map(len, lines)) > 200
    rows = [(1, scattered, "a/x"), (2, wrapped, "b/x"), (3, "\n".join(filler), "c/x"), *[(k, " ".join(dict.fromkeys(words)), "d/x") for k in range(4, 8)]]
    want = list(brute_licences(rows))
    from pyspark.sql import functions as F

    found = licences.scan(spark.createDataFrame(rows, "doc_id int, text string, path string"), path=F.col("path"))
    same(found.drop("cosine"), [(w[0], w[1], w[3], w[4]) for w in want])
    assert {r["doc_id"]: (r["licence"], r["origin"]) for r in found.where("doc_id < 4").collect()} == {1: ("MIT", "file"), 2: ("MIT", "header"), 3: (None, "none")}


def test_op10_brute_force(spark, data, monkeypatch):
    """Rows are whole, and each lies in the shard that it is said to lie in, of the size that the file has."""
    import pyarrow.parquet as pq

    made = []
    monkeypatch.setattr(queries.shards, "ShardStore", lambda *a: made.append(shards_class(*a)) or made[-1])
    rows = queries.op10_shards(spark, data).collect()
    want = []
    for k, s in enumerate(made[0].manifest()["shards"]):
        path = re.sub("^file:/*", "/", s.path)
        assert s.bytes == os.path.getsize(path)
        held = pq.read_table(path, columns=["doc_id", "text"])
        want += [(i, zlib.crc32((t or "").encode()), k, s.bytes) for i, t in zip(held["doc_id"].to_pylist(), held["text"].to_pylist())]
    assert sorted((r["doc_id"], r["text_crc32"], r["shard"], r["shard_bytes"]) for r in rows) == sorted(want)
    assert sorted(w[:2] for w in want) == sorted((i, zlib.crc32((t or "").encode())) for i, t in texts(table(spark, data, "documents")))


def test_op10_compaction_and_versions(spark, odd, tmp_path):
    store = shards.ShardStore(spark, f"file://{tmp_path}/store", target=60_000, base=2_000, fan=3)
    assert store.manifest()["version"] == 0
    parts = [odd.where(f"coalesce(doc_id, 0) % 7 = {k}") for k in range(7)]
    for k, part in enumerate(parts):
        assert store.append(part.coalesce(1)) == k + 1
    before = store.manifest()
    merged = store.compact()
    after = store.manifest()
    assert merged and len(after["shards"]) < len(before["shards"]) and not store.plan(after["shards"])
    want = sorted(map(key, odd.collect()))
    for version in (before["version"], after["version"]):
        assert sorted(map(key, store.read(version).collect())) == want
    assert store.vacuum() > 0 and store.versions() == [after["version"] + 1]
    assert store.manifest()["shards"] == after["shards"]
    assert sorted(map(key, store.read().collect())) == want
    assert store.read_with_shards().select("shard").distinct().count() == len(after["shards"])


def test_op10_each_run_is_a_file(spark, tmp_path):
    store = shards.ShardStore(spark, f"file://{tmp_path}/store", target=30_000, base=1_000, fan=4)
    store.append(spark.range(40_000).repartition(24))
    runs = store.plan(store.manifest()["shards"])
    assert len(runs) > 2
    store.compact()
    left = store.manifest()["shards"]
    assert len(left) < 24 and all(s.bytes <= 1.2 * 30_000 for s in left) and store.read().distinct().count() == 40_000


def test_op10_runs_against_brute_force(spark, tmp_path):
    """Every run is of one tier with enough shards, in order, no larger than the target unless alone; nothing due is left."""
    import random

    store, rng = shards.ShardStore(spark, f"file://{tmp_path}/none", target=1000, base=10, fan=4), random.Random(3)
    for _ in range(300):
        made = [shards.Shard(rng.randint(1, 9), k, f"p{k}", int(10 ** rng.uniform(0, 3.3))) for k in range(rng.randint(0, 30))]
        tiers = {}
        for s in made:
            if s.bytes < 1000:
                tiers.setdefault(next(t for t in range(9) if s.bytes < 10 * 4 ** (t + 1)), []).append(s)
        runs = store.plan(made)
        taken = [s for r in runs for s in r]
        assert len(set(taken)) == len(taken)
        for r in runs:
            of = [t for t, x in tiers.items() if set(r) <= set(x)]
            assert len(of) == 1 and len(tiers[of[0]]) >= 4 and r == sorted(r) and len(r) > 1 and sum(s.bytes for s in r) <= 1000
        for x in tiers.values():  # two neighbours that are left apart would not fit together
            if len(x) >= 4:
                groups, size = [[]], 0
                for s in sorted(x):
                    if groups[-1] and size + s.bytes > 1000:
                        groups, size = [*groups, []], 0
                    groups[-1].append(s)
                    size += s.bytes
                assert [g for g in groups if len(g) > 1] == [r for r in runs if set(r) <= set(x)]


def test_op10_clashing_columns(spark, clashing, tmp_path):
    from pyspark.sql import functions as F

    wide = clashing.select("*", *[F.lit(n).alias(n) for n in ("name", "shard", "file", "at", "arrival", "_metadata", "__arrival")])
    store = shards.ShardStore(spark, f"file://{tmp_path}/store", base=2_000, fan=2)
    store.append(wide)
    names = [c for c in wide.columns if c not in ("TEXT", "shard")]
    out = store.read_with_shards()
    assert out.columns == [*names, "shard", "shard_bytes"] and out.count() == clashing.count()
    assert {r["name"] for r in out.select("name").collect()} == {"name"}
    many = shards.ShardStore(spark, f"file://{tmp_path}/many", base=2_000, fan=2)
    many.append_many(wide.drop("__arrival").withColumn("n", F.when(F.col("arrival").isNotNull(), F.pmod(F.xxhash64("n_chars"), F.lit(12)))), "n")
    assert many.read_with_shards().count() == clashing.count()


def test_op10_drift_and_empty_arrivals(spark, odd, tmp_path):
    from pyspark.sql import functions as F

    store = shards.ShardStore(spark, f"file://{tmp_path}/store")
    few = odd.limit(3)
    store.append(few)
    store.append(few.select("doc_id", "text", F.lit(1.5).alias("Quality")))
    rows = store.read()
    assert rows.columns == [*odd.columns, "Quality"]
    assert sorted(str(r["Quality"]) for r in rows.collect()) == ["1.5"] * 3 + ["None"] * 3 and rows.where("lang is null").count() == 3
    with pytest.raises(ValueError):
        store.append(few.withColumn("doc_id", F.col("doc_id").cast("string")))
    before = store.manifest()
    assert store.append(odd.limit(0)) == before["version"] + 1 and store.manifest()["shards"] == before["shards"]
    assert store.append_many(odd.limit(0), "lang") == []
    store.compact()
    assert store.read().count() == 6


def test_op10_arrivals_in_numeric_order(spark, tmp_path):
    store = shards.ShardStore(spark, f"file://{tmp_path}/store", fan=99)
    store.append_many(spark.range(12).selectExpr("id", "id as n").unionAll(spark.sql("select 99L, null")).coalesce(1), "n")
    assert [r["id"] for r in store.read_with_shards().orderBy("shard").collect()] == [99, *range(12)]


def test_op10_of_two_writers_both_commit(spark, odd, tmp_path):
    store = shards.ShardStore(spark, f"file://{tmp_path}/store")
    once = []

    def change(m):
        if not once:  # another writer is first
            once.append(store.append(odd.limit(2)))
        return m["schema"] or odd.schema.json(), m["shards"]

    assert store.commit(change) == 2 and len(store.manifest()["shards"]) == len(store.manifest(1)["shards"]) > 0
    for k in range(40):  # over full manifests
        store.commit(lambda m, k=k: (m["schema"], [*m["shards"], shards.Shard(50, k, f"x{k}", 1)] if k % 3 else m["shards"][:1]))
    assert [len(store.manifest(v)["shards"]) for v in (3, 4, 5, 6, 42)] == [1, 2, 3, 1, 1]
    assert shards.ShardStore(spark, f"file://{tmp_path}/none").read().count() == 0
