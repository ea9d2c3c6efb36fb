import json

import pytest
from pyspark.sql import functions as F

from stratalex import cli, queries
from stratalex.plans import evaluate, metrics, phases
from stratalex.plans.hierarchy_run import run_pipeline
from stratalex.plans.runner import CallPolicy, Prompt, PromptRegistry, batch_runner, expression, fixed, render, title_labels
from stratalex.policies import ObservabilityPolicy, Policies, flat, load, override
from stratalex.sources import readers, sinks
from stratalex.streaming import ingest


def test_settings_layer():
    p = load({"dedup.prefix_length": 4}, {"STRATALEX__token__max_tokens": "[1, 2, 3, 4]", "OTHER": "x"})
    assert p.dedup.prefix_length == 4 and p.token.max_tokens == (1, 2, 3, 4) and Policies().dedup.prefix_length == 6
    with pytest.raises(KeyError):
        override(p, "dedup.nothing", 1)
    assert flat(p)["dedup.prefix_length"] == 4


def test_runner_retries_and_gives_up(spark, tmp_path):
    def call(prompt, variables):
        if variables["k"] == 0:
            raise OSError("down")
        if variables["k"] == 1 and "hint" not in variables:
            return "not json"
        return json.dumps({"k": variables["k"], "prompt": prompt})

    runner = batch_runner(call, "verify", CallPolicy(attempts=3, backoff_seconds=0), sleep=lambda s: None)
    rows = {r["k"]: r for r in runner(spark.createDataFrame([(0,), (1,), (2,)], "k int")).collect()}
    assert rows[0]["answer"] is None and rows[0]["attempts"] == 3 and "down" in rows[0]["error"]
    assert rows[1]["attempts"] == 2 and json.loads(rows[2]["answer"])["prompt"] == "verify"


def test_prompts():
    registry = PromptRegistry([Prompt("a", "v1", "{x}", ""), Prompt("a", "v2", "{x}{y}", "")])
    assert registry.get("a").variant == "v1"
    registry.deploy("a", "v2")
    assert registry.get("a").variant == "v2"
    registry.roll_back("a")
    assert registry.get("a").variant == "v1" and render("{x}!", {"x": 1}) == "1!"
    with pytest.raises(KeyError):
        render("{z}", {"x": 1})
    with pytest.raises(KeyError):
        registry.get("b")


def test_counters_samples_and_redaction(spark):
    c = metrics.Counters()
    c.add("S0", "pages_seen", 2)
    c.add("S0", "by_language", label="en")
    assert c.snapshot()["S0"]["pages_seen"] == 2 and c.snapshot()["S0"]["by_language"] == {"en": 1}
    with pytest.raises(KeyError):
        c.add("S0", "nothing")
    rows = spark.range(5000)
    some = metrics.sample(rows, "S1", F.col("id"), ObservabilityPolicy(sampling_rate=0.5, max_samples=50))
    again = metrics.sample(rows.repartition(7), "S1", F.col("id"), ObservabilityPolicy(sampling_rate=0.5, max_samples=50))
    assert sorted(some.collect()) == sorted(again.collect()) and some.count() == 50
    assert metrics.sample(rows, "S1", F.col("id"), ObservabilityPolicy(sampling_rate=0.0)).count() == 0
    assert metrics.redacted({"api_key": 1, "a": [{"my_token": 2}]}, ("api_key", "token")) == {"api_key": "<redacted>", "a": [{"my_token": "<redacted>"}]}
    assert metrics.canonical_json({"b": {2, 1}, "a": 1}) == metrics.canonical_json({"a": 1, "b": {1, 2}})
    seen, o = metrics.observed(rows, n=F.count("*"))
    seen.write.format("noop").mode("overwrite").save()
    assert o.get["n"] == 5000


def test_evaluation(spark):
    rows = spark.createDataFrame([(["A", "b"], ["a ", "c"], True), ([], [], True), (["x"], ["x"], False)], "e array<string>, f array<string>, ok boolean")
    s = evaluate.set_f1(rows, "e", "f", F.col("ok")).collect()
    assert [(r["precision"], r["recall"], r["f1"]) for r in s] == [(0.5, 0.5, 0.5), (1.0, 1.0, 1.0), (0.0, 0.0, 0.0)]
    answers = spark.createDataFrame([('{"a": 1}',), ("{",)], "answer string")
    assert evaluate.json_validity(answers, "struct<a:int>").first()["valid_rate"] == 0.5
    q = {r["issue"]: r["rows"] for r in evaluate.quality(rows, {"ok": F.col("ok"), "some": F.size("e") > 0}).collect()}
    assert q == {"<rows>": 3, "ok": 1, "some": 1} and evaluate.recommendations(q, 0.2)[0].startswith("some")
    assert len(evaluate.lever_grid()) == 18
    assert evaluate.best_setting([({"k": 0}, {"f1": 0.5, "precision": 1, "recall": 1}), ({"k": 2}, {"f1": 0.9, "precision": 1, "recall": 1, "valid_rate": 0.5}), ({"k": 4}, {"f1": 0.6, "precision": 1, "recall": 1})]) == {"k": 4}


def test_phases_resume(spark, tmp_path):
    made = []

    def phase(n):
        def run(context):
            made.append(n)
            return context.spark.range(n)

        return run

    p = phases.Pipeline([("one", phase(1)), ("two", phase(2)), ("three", phase(3))])
    context = phases.Context(spark, f"file://{tmp_path}/run", Policies())
    assert p.execute(context).count() == 3 and made == [1, 2, 3]
    later = phases.Context(spark, f"file://{tmp_path}/run", Policies())
    assert p.last_finished(later) == "three" and p.execute(later, resume=True).count() == 3 and made == [1, 2, 3]
    assert later.tables["two"].count() == 2
    p.execute(later, resume_from="three")
    assert made == [1, 2, 3, 3]
    assert len(phases.remove_old(spark, f"file://{tmp_path}/run", keep=1, dry_run=True)) == 1
    assert len(phases.remove_old(spark, f"file://{tmp_path}/run", keep=1)) == 1
    assert phases.finish(context)["checksum"] == phases.manifest(context)["checksum"]
    with pytest.raises(KeyError):
        p.execute(context, resume_from="four")


def test_fixed_point(spark):
    down = lambda df: df.select(F.greatest(F.col("id") - 1, F.lit(0)).alias("id"))
    out, rounds, converged = phases.fixed_point(spark.createDataFrame([(2,)], "id long"), [down])
    assert (out.first()[0], rounds, converged) == (0, 3, True)
    assert phases.fixed_point(spark.createDataFrame([(9,)], "id long"), [down])[1:] == (5, False)


def test_whole_pipeline(spark, data, tmp_path):
    names = ["faculty of letters", "roman history", "ancient coins", "hoard analysis"]
    records = spark.createDataFrame([(k, f"page {k}", "UV"[k % 2], None, k) for k in range(4)], "record_id long, text string, institution string, url string, ord long")

    def named(level):
        said = [{"label": names[level], "normalized": names[level], "aliases": [], "parents": names[level - 1 : level]}]
        return lambda r: r.select("record_id", F.lit(json.dumps(said)).alias("answer"))

    context, manifest = run_pipeline(spark, f"file://{tmp_path}/run", records, [named(k) for k in range(4)], fixed('{"pass": true}'), policies=load({"dedup.phonetic_enabled": False, "dedup.acronym_enabled": False}, {}))
    nodes = {r["level"]: (r["canonical_label"], r["parents"]) for r in context.tables["finalize"].collect()}
    assert nodes == {0: (names[0], []), 1: (names[1], ["L0:faculty of letters"]), 2: (names[2], ["L1:roman history"]), 3: (names[3], ["L2:ancient coins"])}
    assert manifest["notes"]["post_process"]["converged"] and manifest["notes"]["hierarchy"]["passed"]


def test_readers_and_sinks(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    text = "Some  text"
    import hashlib

    good = {"institution": "U", "url": "http://u.edu/a", "http_status": 200, "content_type": "text/html", "text": text, "lang": "en", "checksum": hashlib.sha256(b"Some text").hexdigest(), "fetched_at": "2025-01-01T00:00:00Z"}
    lines = [json.dumps(good), json.dumps({"snapshot": good | {"url": "http://u.edu/b"}, "language_confidence": 0.9}), json.dumps(good | {"http_status": 404}), "{broken", "", json.dumps(good | {"checksum": "x"}), json.dumps(good | {"url": "ftp://x"})]
    (folder / "a.jsonl").write_text("\n".join(lines))
    pages, bad = readers.snapshots(spark, f"file://{folder}")
    assert {r["url"] for r in pages.collect()} == {"http://u.edu/a", "http://u.edu/b"} and sorted(r["error"] for r in bad.collect()) == ["checksum does not match the text", "malformed-json", "url is no http(s) URL"]
    sinks.document(spark, {"b": 1, "a": [1]}, f"file://{tmp_path}/m.json")
    assert sinks.read_document(spark, f"file://{tmp_path}/m.json") == {"a": [1], "b": 1} and sinks.read_document(spark, f"file://{tmp_path}/none.json") is None
    sinks.export(spark.createDataFrame([(1, ["a"])], "b int, a array<string>"), f"file://{tmp_path}/csv")
    assert spark.read.option("header", True).csv(f"file://{tmp_path}/csv").columns == ["a", "b"]
    (tmp_path / "labels.json").write_text(json.dumps([{"input": "t", "expected": ["x"], "campus": "U"}]))
    assert tuple(readers.labelled(spark, f"file://{tmp_path}/labels.json").first()) == ("t", ["x"], "U", None)
    done = spark.createDataFrame([(1,)], "record_id long")
    assert readers.unprocessed(spark.range(3).withColumnRenamed("id", "record_id"), done).count() == 2


def test_evidence_reader(spark, tmp_path):
    rows = [{"candidate": {"level": 2, "label": "X", "normalized": "x", "parents": ["p"], "support": {"records": 2, "institutions": 1, "count": 3}}, "institutions": ["U"], "record_fingerprints": ["f"]}, {"level": 1, "label": "Y", "normalized": "y", "parents": ["p"], "supporting_institutions": ["V"], "support_details": {"institution": "W", "fingerprints": ["g"]}}]
    (tmp_path / "e.jsonl").write_text("\n".join(map(json.dumps, rows)))
    found, _ = readers.evidence(spark, f"file://{tmp_path}/e.jsonl")
    got = {r["label"]: (r["institutions"], r["record_fingerprints"], r["count"]) for r in found.collect()}
    assert got == {"X": (["U"], ["f"], 3), "Y": (["V", "W"], ["g"], 0)}


def test_evidence_reader_takes_every_shape(spark, tmp_path):
    base = {"level": 1, "normalized": "y", "parents": ["p"]}
    rows = [base | {"label": "a", "institutions": "mit"}, base | {"label": "b", "provenance": {"institution": " u  v "}}, base | {"label": "c", "provenance": [{"institution": "w"}, {"institution": None}]}, base | {"label": "d", "records": ["r1", "r2"]}, {"candidate": base | {"label": "e", "institutions": ["x"], "support_details": {"institutions": ["y"], "record_fingerprints": ["r3"]}}, "institutions": ["z"]}, base | {"label": "f"}]
    (tmp_path / "e.jsonl").write_text("\n".join([*map(json.dumps, rows), "{broken"]))
    found, bad = readers.evidence(spark, f"file://{tmp_path}/e.jsonl")
    got = {r["label"]: (r["institutions"], r["record_fingerprints"]) for r in found.collect()}
    assert got == {"a": (["mit"], []), "b": (["u v"], []), "c": (["w"], []), "d": ([], ["r1", "r2"]), "e": (["x", "y", "z"], ["r3"]), "f": ([], [])}
    assert [r["label"] for r in found.orderBy("ord").collect()] == list("abcdef") and bad.count() == 1


def test_checksums_cover_whole_values():
    assert metrics.canonical_json(list(range(512))) != metrics.canonical_json(list(range(600)))
    deep = lambda x, n: x if not n else {"a": deep(x, n - 1)}
    assert metrics.canonical_json(deep({"b": 1, "c": 2}, 12)) == metrics.canonical_json(deep({"c": 2, "b": 1}, 12))


def test_long_chains_are_no_cycles(spark):
    from stratalex.operators import hierarchy

    chain = spark.createDataFrame([(str(i), str(i + 1)) for i in range(12)], "parent string, child string")
    assert hierarchy.cyclic(chain).count() == 0


def test_command_line(spark, tmp_path, capsys):
    rows = [{"candidate": {"level": 0, "label": "Arts", "normalized": "arts", "support": {"records": 1, "institutions": 1, "count": 1}}, "institutions": ["U"], "record_fingerprints": ["f"]}]
    (tmp_path / "e.jsonl").write_text("\n".join(map(json.dumps, rows)))
    assert cli.main(["frequency", "--input", f"file://{tmp_path}/e.jsonl", "--output", f"file://{tmp_path}/out"]) == 0
    assert json.loads((tmp_path / "out/metadata.json").read_text())["kept"] == 1
    concepts = [{"id": "r", "level": 0, "canonical_label": "R", "parents": []}, {"id": "n", "level": 1, "canonical_label": "N", "parents": ["r"]}]
    (tmp_path / "c.jsonl").write_text("\n".join(map(json.dumps, concepts)))
    assert cli.main(["assemble", "--input", f"file://{tmp_path}/c.jsonl", "--output", f"file://{tmp_path}/tree", "--format", "dot"]) == 0
    assert cli.main(["config", "--set", "dedup.prefix_length=3"]) == 0 and '"dedup.prefix_length": 3' in capsys.readouterr().out


def test_stream(spark, tmp_path):
    folder = tmp_path / "stream"
    folder.mkdir()
    page = {"institution": "U", "url": "http://u.edu/a", "text": "A sentence about graphs, long enough to stay.", "lang": "en", "language_confidence": 0.9, "fetched_at": "2025-01-01T00:00:00Z"}
    (folder / "a.json").write_text("\n".join(json.dumps(page | {"url": f"http://u.edu/{k}"}) for k in range(2)))
    stream = ingest.fresh_pages(ingest.snapshots(spark, f"file://{folder}"))
    q = ingest.records_to(stream, f"file://{tmp_path}/records", f"file://{tmp_path}/checkpoint")
    q.awaitTermination(90)
    assert spark.read.parquet(f"file://{tmp_path}/records").count() == 1


def test_every_query_runs(spark, data):
    for name in ("s1_candidates", "crawl_pages", "html_text", "validate_model", "held_out_split", "evidence_sample", "minhash_pairs", "double_metaphone_blocks"):
        assert queries.QUERIES[name](spark, data).count() >= 0
    assert title_labels and expression
