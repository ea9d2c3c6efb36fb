import json

import pytest
from pyspark.sql import functions as F

from stratalex.operators import crawl, dedup, disambiguate, extract, frequency, hierarchy, segment, validate, verify
from stratalex.operators.components import components
from stratalex.plans.runner import expression, fixed
from stratalex.policies import DedupPolicy, DisambiguationPolicy, ExtractionPolicy, HierarchyPolicy, TokenPolicy, ValidationPolicy, WebPolicy

EVIDENCE = "level int, label string, normalized string, parents array<string>, aliases array<string>, records long, count long, institutions array<string>, record_fingerprints array<string>, ord long"


def evidence(spark, *rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], EVIDENCE)


def decided(spark, *rows):
    return frequency.aggregate(evidence(spark, *rows)).orderBy("level", "normalized").collect()


def test_groups_join_over_case_of_parents(spark):
    d = decided(spark, (2, "Deep Nets", "deep nets", ["ML"], ["DN"], 1, 1, ["uni a"], ["record:aax"]), (2, "deep nets", "Deep  Nets", ["ml"], [], 1, 2, ["Uni B"], ["record:bbx"]))
    assert len(d) == 1 and d[0]["label"] == "Deep Nets" and d[0]["aliases"] == ["DN", "Deep Nets", "deep nets"]
    assert tuple(d[0]["support"]) == (2, 2, 3) and d[0]["passed"] and d[0]["weight"] == pytest.approx(2 + 0.3 * 1.3862943611)


def test_thresholds_by_level(spark):
    d = decided(spark, (2, "x", "x", ["p"], [], 5, 1, ["a"], ["record:aax"]), (3, "y", "y", ["p"], [], 1, 1, ["a", "b"], ["record:aax", "record:bbx"]), (0, "z", "z", ["ignored"], [], 1, 1, [], []))
    assert [(r["level"], r["passed"]) for r in d] == [(0, True), (2, False), (3, False)]
    assert d[0]["institutions"] == ["placeholder::unknown"] and d[0]["parents"] == [] and d[0]["support"]["records"] == 1


def test_versions_count_once_in_an_institution(spark):
    d = decided(spark, (3, "x", "x", ["p"], [], 1, 1, ["a"], ["syllabus-x#v1", "syllabus-x#v2"]), (3, "x", "x", ["p"], [], 1, 1, ["b"], ["syllabus-x#v1"]))
    assert d[0]["record_fingerprints"] == ["syllabus-x#v1"] and d[0]["support"]["records"] == 1


def test_orphaned_candidates_are_quarantined(spark):
    rows = frequency.aggregate(evidence(spark, (2, "x", "x", [], [], 1, 1, ["a", "b"], ["record:ax"]), (2, "y", "y", [], [], 1, 1, ["a"], ["record:ax"])))
    good, bad = frequency.quarantine(rows)
    assert [r["label"] for r in good.collect()] == ["y"] and [r["label"] for r in bad.collect()] == ["x"]
    assert frequency.aggregate(evidence(spark, (0, "a", "a", [], [], 1, 1, [], [])).limit(0)).count() == 0


def test_top_institutions(spark):
    rows = spark.createDataFrame([("U", "Arts -> Music", "s1"), ("U", "Arts -> Dance", None), ("U", "Law", "s2"), ("V", "Law -> X", "s2"), ("W", " -> nothing", "s2")], "institution string, department_path string, sheet_name string")
    top = frequency.top_institutions(rows, 5).collect()
    assert [(r["institution"], r["college_count"], r["total_occurrences"], r["colleges"]) for r in top] == [("U", 2, 3, ["Arts", "Law"]), ("V", 1, 1, ["Law"])]


PAGE = "page long, text string, lang string, language_confidence string, institution string, url string, canonical_url string, fetched_at timestamp"


def blocks(spark, text, policy=ExtractionPolicy()):
    found = segment.blocks(spark.createDataFrame([(1, text, "en", "0.9", "U", "http://u.edu/", None, None)], PAGE), policy)
    return [(r["ord"], r["block_type"], r["section"], r["text"], r["boilerplate"]) for r in found.orderBy(F.coalesce("ord", F.lit(99))).collect()]


def test_segmentation(spark):
    text = "PROGRAM OVERVIEW\nTopics:\n- first item\n- second item\n\nAbout us:\nA paragraph, over\ntwo lines, of prose.\n\n© 2024 University\nContact us 123, please\n"
    found = blocks(spark, text)
    assert [b[1] for b in found if not b[4]] == ["header", "header", "list", "header", "paragraph"]
    assert found[2][2:4] == ("Topics:", "- first item\n- second item") and found[4][3] == "A paragraph, over two lines, of prose."
    assert [b[0] for b in found if not b[4]] == [0, 1, 2, 3, 4] and any(b[4] for b in found)


def test_tables(spark):
    assert ("table", "a | b | c, 1 d | e | f, 2") == blocks(spark, "a | b | c, 1\nd | e | f, 2")[0][1:4:2]
    assert blocks(spark, "x1,\ty\nz2,\tw")[0][1] == "table"
    assert blocks(spark, "one,   two,   three\nfour,   fife,   six, 7")[0][1] == "table" and blocks(spark, "one,  two,  three 3")[0][1] == "paragraph"


def test_bare_lists(spark):
    assert blocks(spark, "- one, 1\n- two, 2", ExtractionPolicy(preserve_list_structure=False))[0][3] == "one, 1 two, 2"


@pytest.mark.parametrize(("lang", "confidence", "policy", "kept"), [("en", "0.9", {}, True), ("en", "0.2", {}, False), ("en", None, {}, False), ("en-US", "0.9", {}, True), ("fr", "0.9", {}, False), ("en", None, {"require_language_confidence": False}, True), ("fr", "0.9", {"target_language": "any"}, True), ("en", "n/a", {}, False)])
def test_language_gate(spark, lang, confidence, policy, kept):
    row = spark.createDataFrame([(lang, confidence)], "l string, c string")
    assert row.select(segment.language_allowed(F.col("l"), F.col("c"), ExtractionPolicy(**policy))).first()[0] is kept


def test_records_without_near_copies(spark):
    para = "The same sentence about graph learning, repeated in full."
    other = "Quite another sentence on the theory of numbers, once."
    page = spark.createDataFrame([(1, f"{para}\n\n{other}\n\n{para}\n\nshort 1", "en", "0.95", "U", "http://u.edu/a", "http://u.edu/c", None)], PAGE)
    rows = segment.source_records(page).orderBy("ord").collect()
    assert [r["text"] for r in rows] == [para, other] and rows[0]["provenance"]["url"] == "http://u.edu/c"
    assert rows[0]["meta"]["hints"] == {"source": "web", "level": "S0", "language_confidence": "0.950", "block_type": "paragraph", "order": "0"}
    assert segment.greedy_duplicates(["a b c d", "A b c d", "x", "x", "", " "], 0.95) == [1, 3, 5]


LABELS = "n int, level int, label string, normalized string, aliases array<string>, parents array<string>"
RATIONALE = "struct<passed_gates:map<string,boolean>,reasons:array<string>,thresholds:map<string,double>>"


def verified(spark, rows, runner=None, policy=TokenPolicy()):
    df = spark.createDataFrame([(i, level, t, t, [], ["p"]) for i, (level, t) in enumerate(rows)], LABELS).withColumn("rationale", F.lit(None).cast(RATIONALE))
    return verify.decide(verify.evaluate(df, policy), runner or fixed('{"pass": true}'), policy).orderBy("n").collect()


def test_rules_and_model(spark):
    no = fixed('{"pass": false, "reason": "vague"}')
    r = verified(spark, [(2, "robotics"), (2, "e-learning"), (3, "NeurIPS"), (3, "neurips 2023"), (2, "a_b"), (2, "machine learning"), (1, "x")], no)
    assert [x["passed"] for x in r] == [False, True, False, True, False, True, False]
    assert r[1]["rationale"]["passed_gates"]["token_llm"] is None and "bypass:multi_token" in r[1]["rationale"]["reasons"]
    assert not r[2]["rule_evaluation"]["passed"] and r[4]["rule_evaluation"]["suggestions"] == ["a b", "ab"]
    yes = verified(spark, [(2, "robotics"), (2, "a_b"), (3, "KDD")])
    assert [x["passed"] for x in yes] == [True, False, False]
    loose = verified(spark, [(2, "a_b")], policy=TokenPolicy(prefer_rule_over_model=False))
    assert loose[0]["passed"] and loose[0]["aliases"] == ["a b", "a_b", "ab"]


@pytest.mark.parametrize(("answer", "passed"), [('{"pass": true}', True), ('{"ok": "Yes"}', True), ('{"passed": 0}', False), ('{"success": "2.5"}', True), ('{"pass": "NaN"}', False), ('{"pass": null, "ok": true}', False), ('{"x": 1}', False), ("[1]", False), (None, False)])
def test_model_answers(spark, answer, passed):
    row = spark.createDataFrame([(answer,)], "a string")
    assert row.select(verify.parse_answer(F.col("a"))["passed"]).first()[0] is passed


CONCEPT = "id string, level int, canonical_label string, parents array<string>, aliases array<string>, support struct<records:bigint,institutions:bigint,count:bigint>"


def concepts(spark, *rows):
    return spark.createDataFrame([(i, level, label, parents, aliases, (1, inst, 1)) for i, level, label, parents, aliases, inst in rows], CONCEPT)


def test_similar_concepts_merge(spark):
    c = concepts(spark, ("a", 2, "computer vision", ["p"], [], 3), ("b", 2, "computer visions", ["p"], ["Vis"], 2), ("c", 2, "quantum optics", ["p"], [], 1))
    links = dedup.edges(dedup.scored(c))
    survivors, merges = dedup.merge(c, links)
    rows = {r["id"]: r for r in survivors.collect()}
    assert set(rows) == {"a", "c"} and tuple(rows["a"]["support"]) == (2, 5, 2) and rows["a"]["aliases"] == ["Vis", "computer visions"]
    op = merges.first()
    assert op["winners"] == ["a"] and op["losers"] == ["b"] and json.loads(op["evidence"])["b"]["driver"] == "jaro_winkler"


def test_acronym_by_alias_stops_early(spark):
    c = concepts(spark, ("a", 2, "natural language processing", ["p"], [], 1), ("b", 2, "language technology", ["p"], ["NLP"], 1))
    e = dedup.edges(dedup.scored(c)).first()
    assert e["score"] == 1.0 and e["driver"] == "abbrev_score" and e["features"]["jaro_winkler"] is None


def test_driver_of_an_affix(spark):
    c = concepts(spark, ("a", 2, "control systems", ["p"], [], 1), ("b", 2, "control", ["p"], [], 1))
    s = dedup.scored(c).where("block like 'prefix:%'").first()
    assert s["driver"] == "suffix_prefix_hint" and s["score"] == pytest.approx(max(s["features"]["jaro_winkler"], 0.5))


def test_parents_keep_concepts_apart(spark):
    c = concepts(spark, ("a", 2, "signal processing", ["p", "q"], [], 1), ("b", 2, "signal processing", ["q", "r"], [], 1), ("c", 2, "signal processing", ["r", "s"], [], 1), ("d", 2, "signal processing", ["z"], [], 1))
    links = dedup.edges(dedup.scored(c))
    assert {(r["a"], r["b"]) for r in links.collect()} == {("a", "b"), ("b", "c")}
    assert dedup.merge(c, links)[0].count() == 4  # the component shares no parent


def test_blocks_are_cut_and_capped(spark):
    c = concepts(spark, *[(f"{k:02d}", 2, f"same label {k:02d}", ["p"], [], 1) for k in range(10)])
    p = DedupPolicy(max_block_size=4, phonetic_enabled=False, acronym_enabled=False)
    sizes = {r["block"]: r["count"] for r in dedup.block_members(c, p).groupBy("block").count().collect()}
    assert sizes == {"prefix:same l|0000": 4, "prefix:same l|0001": 4, "prefix:same l|0002": 2}
    few = dedup.pairs(c, DedupPolicy(max_comparisons=5, phonetic_enabled=False, acronym_enabled=False))
    assert sorted((r["a"], r["b"]) for r in few.collect()) == [("00", f"0{k}") for k in range(1, 6)]
    again = concepts(spark, ("a", 2, "x", [], [], 1), ("a", 2, "y", [], [], 1)).withColumn("ord", F.monotonically_increasing_id())
    assert [r["canonical_label"] for r in dedup.last_of_each(again).collect()] == ["y"]


def test_probe_filters_sound_alikes(spark):
    c = concepts(spark, ("a", 2, "knight", ["p"], [], 1), ("b", 2, "nit", ["p"], [], 1))
    rows = dedup.scored(c, DedupPolicy(phonetic_probe_threshold=0.95)).collect()
    assert rows and all(r["probed_out"] and not r["passed"] for r in rows)


def test_children_follow_the_winner(spark):
    c = concepts(spark, ("w", 1, "w", [], [], 1), ("k", 2, "k", ["l", "w", "m"], [], 1))
    merges = spark.createDataFrame([(["w"], ["l"])], "winners array<string>, losers array<string>")
    assert {r["id"]: r["parents"] for r in dedup.remap_parents(c, merges).collect()} == {"w": [], "k": ["w", "m"]}


def test_components(spark):
    edges = [(f"n{i:02d}", f"n{i + 1:02d}") for i in range(40)] + [("z", "y"), ("q", "q")]
    found = {(r["node"], r["root"]) for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert found == {(f"n{i:02d}", "n00") for i in range(41)} | {("z", "y"), ("y", "y")}


def test_validation_rules(spark):
    c = spark.createDataFrame([("a", 0, "x", ["p"]), ("b", 2, "x", []), ("c", 3, "Trends in KDD", ["p"]), ("d", 3, "kdd methods", ["p"]), ("e", 1, "fine", ["p"])], "id string, level int, canonical_label string, parents array<string>")
    r = {x["id"]: x["rule"] for x in validate.rules(c).collect()}
    assert r["a"]["hard"] == ["root_has_parents"] and r["b"]["hard"] == ["missing_parents"]
    assert r["c"]["hard"] == ["forbidden_pattern:kdd$"] and r["c"]["soft"] == ["venue_name_detected:kdd"]
    assert r["d"]["passed"] and r["d"]["soft"] == ["venue_name_detected:kdd"] and r["d"]["summary"].startswith("1 soft violations")
    assert r["e"]["summary"] == "Rule checks succeeded"
    need = validate.rules(c.where("id = 'e'"), ValidationPolicy(required_vocabularies={1: ("science",)})).first()["rule"]
    assert need["hard_fail"] and need["hard"] == ["missing_required_vocab:1"]
    assert validate.rule_findings(validate.rules(c)).count() == 6


SNAP = "snap long, institution string, url string, text string"


def test_evidence(spark):
    c = spark.createDataFrame([("a", 2, "graph theory", ["p"]), ("b", 2, "on the art of graph theory here", ["p"]), ("c", 2, "nothing", ["p"])], "id string, level int, canonical_label string, parents array<string>")
    s = spark.createDataFrame([(1, "U", "https://en.wikipedia.org/x", "Graph Theory is. " + "x" * 300 + " U says graph theory; On the Art of Graph Theory here."), (2, "V", "https://v.edu/", "monograph theory"), (3, "W", "https://w.com/", "other")], SNAP)
    found = validate.mentions(c, s)
    assert {(r["id"], r["snap"]) for r in found.collect()} == {("a", 1), ("a", 2), ("b", 1)}
    shown = validate.snippets(c, found).where("id = 'a'").orderBy("snap", "at").collect()
    assert [(r["snap"], r["at"], round(r["score"], 2)) for r in shown] == [(1, 0, 1.3), (1, 325, 1.5), (1, 353, 1.5), (2, 4, 1.24)]
    top = validate.top_snippets(validate.snippets(c, found)).where("id = 'a'").orderBy("rank").collect()
    assert [(r["snap"], r["at"]) for r in top] == [(1, 325), (1, 353), (1, 0)]
    assert validate.top_snippets(validate.snippets(c, found), ValidationPolicy(max_snippets=0)).count() == 0
    blocked = validate.mentions(c, s, block=1)
    assert {(r["id"], r["snap"]) for r in blocked.collect()} == {("a", 1), ("a", 2), ("b", 1)}


def vote(spark, rule=(True, False), web=None, model=None, **policy):
    df = spark.range(1).select(F.struct(F.lit(rule[0]).alias("passed"), F.lit(rule[1]).alias("hard_fail"), F.lit("r").alias("summary")).alias("rule"))
    if web is not None:
        df = df.withColumn("web", F.struct(F.lit(web[0]).alias("passed"), F.lit(web[1]).alias("unknown"), F.lit(web[2]).alias("n"), F.lit(web[3]).alias("mean_score"), F.lit("w").alias("summary")))
    if model is not None:
        df = df.withColumn("model", F.struct(F.lit(model[0]).alias("passed"), F.lit(model[1]).alias("confidence"), F.lit("m").alias("summary")))
    return validate.vote(df, ValidationPolicy(**policy)).first()["decision"]


def test_votes(spark):
    assert not vote(spark, (True, True), (True, False, 3, 1.0))["passed"]
    assert vote(spark, (True, False), (False, False, 0, 0.0), (False, 0.0))["confidence"] == pytest.approx(1 / 2.1)
    assert not vote(spark, (True, False), (False, False, 0, 0.0), (False, 0.0))["passed"]
    assert vote(spark, (True, False), (False, True, 0, 0.0), (False, 0.0))["passed"]  # an unknown web result takes no part
    tie = {"rule_weight": 1.0, "web_weight": 1.0, "model_weight": 0.0}
    assert vote(spark, (False, False), (True, False, 2, 0.9), **tie)["passed"] and not vote(spark, (False, False), (True, False, 2, 0.5), **tie)["passed"]
    assert vote(spark, (True, False), (False, False, 0, 0.0), tie_break_conservative=False, **tie)["passed"]
    assert not vote(spark, (True, False), rule_weight=0.0)["passed"]
    with pytest.raises(ValueError):
        ValidationPolicy(rule_weight=-1.0)


def test_packing_stops_at_the_budget(spark):
    top = spark.createDataFrame([("a", k, "x" * n) for k, n in ((1, 50), (2, 30), (3, 10))], "id string, rank int, snippet string")
    kept = validate.packed(top, ValidationPolicy(max_evidence_tokens=15)).collect()
    assert [r["rank"] for r in kept] == [1]
    assert validate.packed(top, ValidationPolicy(max_evidence_tokens=1)).count() == 1


def test_windows(spark):
    c = spark.createDataFrame([("c", 1, "big idea", ["p"])], "id string, level int, canonical_label string, parents array<string>")
    r = spark.createDataFrame([("c", 0, "a b Big Idea c d e big idea", "U", None), ("c", 1, "no mention of it here", None, None), ("c", 2, " ", None, None)], "concept_id string, n int, text string, institution string, url string")
    found = {(x["source_index"], x["text"]) for x in disambiguate.windows(c, r, 2).collect()}
    assert found == {(0, "b Big Idea c"), (0, "e big idea"), (1, "no mention")}
    with pytest.raises(ValueError):
        disambiguate.windows(c, r, 0)


SENSE = "id string, ord int, level int, canonical_label string, parents array<string>, aliases array<string>, support struct<records:bigint,institutions:bigint,count:bigint>, institutions array<string>"


def shared(spark):
    return spark.createDataFrame([("a", 0, 2, "Transformers", ["ml"], [], (3, 2, 5), ["U"]), ("b", 1, 2, "transformers ", ["power"], ["trafo"], (2, 1, 2), ["V"]), ("c", 2, 2, "graphs", ["ml"], [], (1, 1, 1), ["U"])], SENSE)


def answer(*senses, **more):
    return fixed(json.dumps({"separable": True, "confidence": 0.9, "senses": list(senses)} | more))


def test_ambiguous_labels_split(spark):
    out, ops, deferred = disambiguate.disambiguate(shared(spark), None, answer({"label": "neural", "parent_hints": ["ML"], "evidence_indices": [0, 1]}, {"label": "electric", "parent_hints": ["power"]}))
    rows = {r["canonical_label"]: r for r in out.collect()}
    assert set(rows) == {"graphs", "Transformers - neural", "Transformers - electric"} and deferred.count() == 0
    assert rows["Transformers - neural"]["parents"] == ["ml"] and rows["Transformers - electric"]["parents"] == ["power"]
    supports = [tuple(rows[f"Transformers - {s}"]["support"]) for s in ("neural", "electric")]
    assert [sum(x) for x in zip(*supports)] == [5, 3, 7] and rows["Transformers - neural"]["id"].startswith("a::split::") and ops.first()["source_id"] == "a"


def test_splits_are_deferred(spark):
    same = answer({"label": "x", "parent_hints": ["ml"]}, {"label": "y", "parent_hints": ["ml"]})
    one = answer({"label": "x"})
    unsure = answer({"label": "x", "parent_hints": ["ml"]}, {"label": "y", "parent_hints": ["power"]}, confidence=0.0)
    for runner, why in ((same, "lineage"), (one, "distinct senses"), (unsure, "threshold to defer"), (fixed("broken"), "distinct senses")):
        out, _, deferred = disambiguate.disambiguate(shared(spark), None, runner)
        rows = deferred.collect()
        assert out.count() == 3 and {r["id"] for r in rows} == {"a", "b"} and all(why in r["reason"] for r in rows)
    with pytest.raises(ValueError):
        DisambiguationPolicy(defer_threshold=0.9)


def test_collision_gates(spark):
    found = {r["label"]: r for r in disambiguate.collisions(shared(spark)).collect()}
    assert set(found) == {"transformers"} and found["transformers"]["status"] == "flagged" and found["transformers"]["parent_divergence"] == 1.0
    same = shared(spark).withColumn("parents", F.array(F.lit("ml")))
    assert disambiguate.collisions(same).first()["status"] == "single-parent"
    windows = spark.createDataFrame([("a", "same words"), ("b", "same words")], "concept_id string, text string")
    assert disambiguate.collisions(shared(spark), windows).first()["status"] == "context-overlap"


@pytest.mark.parametrize(("total", "weights", "want"), [(5, [1.0, 1.0], [3, 2]), (3, [1.0, 1.0], [1, 2]), (0, [2.0, 1.0], [0, 0]), (1, [1.0, 1.0, 1.0], [1, 0, 0]), (10, [3.0, 1.0], [8, 2]), (7, [0.0, 0.0], [3, 4])])
def test_shares_sum_to_the_total(spark, total, weights, want):
    got = spark.range(1).select(disambiguate.shares(F.lit(total).cast("long"), F.array(*[F.lit(w) for w in weights]))).first()[0]
    assert got == want


TREE = "id string, level int, canonical_label string, parents array<string>"


def tree(spark, *rows):
    return spark.createDataFrame([(i, level, i, parents) for i, level, parents in rows], TREE)


ROWS = (("r", 0, []), ("n", 1, ["r"]), ("s", 2, ["n"]), ("lost", 2, ["gone"]), ("skip", 3, ["n"]), ("two", 2, ["n", "n2"]), ("n2", 1, ["r"]), ("n", 1, ["r"]), ("bare", 1, []), ("deep", 7, ["r"]), ("below", 3, ["lost"]))


def test_assembly_quarantines_and_reports(spark):
    h = hierarchy.assemble(tree(spark, *ROWS))
    assert {r["id"] for r in h.nodes.collect()} == {"r", "n", "n2", "s"}
    orphans = {r["concept_id"]: (r["strategy"], r["detail"]) for r in h.orphans.collect()}
    assert orphans["lost"] == ("quarantine", "missing-parent") and orphans["below"][0] == "quarantine"
    assert orphans["skip"] == ("error", "an edge skips a level") and orphans["two"] == ("error", "several parents") and orphans["n"][1] == "the id is there already"
    assert orphans["bare"][1] == "no parent" and orphans["deep"][1] == "the level is outside 0 to 3"
    told = hierarchy.report(h.nodes, h.edges)
    assert told["passed"] and told["acyclic"] and told["statistics"]["node_count"] == 4 and told["statistics"]["edge_count"] == 3
    assert {r["path"] for r in hierarchy.lineages(h.nodes).collect()} == {"r", "r > n", "r > n2", "r > n > s"}


def test_placeholders(spark):
    h = hierarchy.assemble(tree(spark, ("x", 2, ["gone"]), ("r", 0, [])), HierarchyPolicy(orphan_strategy="attach_placeholder"))
    ids = {r["id"]: r["parents"] for r in h.nodes.collect()}
    assert ids == {"r": [], "placeholder::level0": [], "placeholder::level1": ["placeholder::level0"], "x": ["placeholder::level1"]}
    with pytest.raises(ValueError):
        HierarchyPolicy(orphan_strategy="adopt")


def test_multi_parent_exceptions_cycles_and_size(spark):
    h = hierarchy.assemble(tree(spark, *ROWS), HierarchyPolicy(multi_parent_exceptions=("two",), allow_shortcuts=True))
    assert {"two", "skip"} <= {r["id"] for r in h.nodes.collect()}
    loop = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("r", "a"), ("r", "x")], "parent string, child string")
    assert {(r["parent"], r["child"]) for r in hierarchy.cyclic(loop).collect()} == {("a", "b"), ("b", "c"), ("c", "a")}
    assert hierarchy.assemble(tree(spark, *ROWS), HierarchyPolicy(max_nodes=2)).nodes.count() == 2
    assert {r["code"] for r in hierarchy.violations(tree(spark, *ROWS)).collect()} == {"invalid-level", "missing-parent", "non-unique-path"}


RECORD = "record_id long, text string, institution string, url string, ord long"


def test_extraction(spark):
    records = spark.createDataFrame([(1, "t1", "U", None, 1), (2, "t2", "V", None, 2), (3, "t3", "U", None, 3)], RECORD)
    said = {1: '[{"label": "Dept of Physics", "normalized": "physics", "aliases": ["Phys"], "parents": ["College of Sciencee"]}]', 2: 'Sure: {"candidates": [{"label": "Physics", "normalized": "physics", "aliases": null, "parents": ["college of science"]}]}', 3: "no idea"}
    runner = expression(F.element_at(F.create_map(*[x for k, v in said.items() for x in (F.lit(k), F.lit(v))]), F.col("record_id").cast("int")))
    parents = spark.createDataFrame([(0, "Science", ["Natural Science"])], "level int, label string, aliases array<string>")
    found, bad = extract.extract_level(records, 1, lambda r: runner(r).select("record_id", "answer"), parents)
    rows = found.collect()
    assert len(rows) == 1 and rows[0]["parents"] == ["L0:science"] and rows[0]["normalized"] == "physics"
    assert tuple(rows[0]["support"]) == (2, 2, 2) and {"Phys", "physics", "Physics", "Dept of Physics"} <= set(rows[0]["aliases"])
    assert [r["record_id"] for r in bad.collect()] == [3]


def test_unresolved_parents(spark):
    records = spark.createDataFrame([(1, "t", "U", None, 1)], RECORD)
    runner = fixed('[{"label": "x y", "normalized": "n", "parents": ["Nowhere  Land"]}, {"label": " ", "normalized": "z"}]')
    found, _ = extract.extract_level(records, 1, lambda r: runner(r).select("record_id", "answer"))
    assert [r["parents"] for r in found.collect()] == [["UNRESOLVED:nowhere land"]]


def test_crawl(spark):
    pages = spark.createDataFrame([("http://a.edu/", '<a href="/b">b</a><a href="/news/x">n</a><a href="http://o.com/">o</a>'), ("http://a.edu/b", '<a href="/c#f">c</a><a href="/">home</a>'), ("http://a.edu/c", "end"), ("http://o.com/", "out")], "url string, html string")
    seeds = spark.createDataFrame([("HTTP://A.edu#x", 1)], "url string, priority int")
    got = {(r["url"], r["depth"]) for r in crawl.crawl(seeds, crawl.from_pages(pages)).collect()}
    assert got == {("http://a.edu/", 0), ("http://a.edu/b", 1), ("http://a.edu/c", 2)}
    assert crawl.crawl(seeds, crawl.from_pages(pages), WebPolicy(max_pages=2)).count() == 2
    robots = spark.createDataFrame([("a.edu", 200, "User-agent: *\nDisallow: /b\nCrawl-delay: 2")], "host string, status int, body string")
    judged = {r["url"]: (r["allowed"], r["crawl_delay"]) for r in crawl.robots_allow(pages.select("url"), robots).collect()}
    assert judged["http://a.edu/b"] == (False, 2.0) and judged["http://o.com/"] == (True, None)


def test_sitemaps_cache_and_gates(spark):
    body = '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc> http://a/1 </loc></url><url><loc>http://a/2</loc></url></urlset>'
    index = "<sitemapindex><sitemap><loc>http://a/s.xml</loc></sitemap></sitemapindex>"
    maps = spark.createDataFrame([("u", body), ("v", index)], "url string, body string")
    assert {(r["loc"], r["kind"]) for r in crawl.sitemap_urls(maps).collect()} == {("http://a/1", "page"), ("http://a/2", "page"), ("http://a/s.xml", "sitemap")}
    now = F.lit("2025-02-01 00:00:00").cast("timestamp")
    rows = spark.createDataFrame([("k", "u1", "2025-01-31 00:00:00", 10), ("k", "u2", "2025-01-31 12:00:00", 10), ("l", "u3", "2025-01-01 00:00:00", 5), ("m", "u4", "2025-01-30 00:00:00", 7)], "checksum string, url string, stored_at string, size long").withColumn("stored_at", F.col("stored_at").cast("timestamp"))
    kept = {r["checksum"]: r["alias_urls"] for r in crawl.merge_cache(None, rows, now).collect()}
    assert kept == {"k": ["u1", "u2"], "m": ["u4"]}
    assert [r["checksum"] for r in crawl.merge_cache(None, rows, now, WebPolicy(max_cache_bytes=12)).collect()] == ["k"]
    pages = spark.createDataFrame([("http://a.edu/1", "<p>" + "long text " * 30 + "</p>", "en", 0.9), ("http://a.edu/2", "<p>short</p>", "en", 0.9), ("http://a.edu/3", "<p>" + "lang text " * 30 + "</p>", "fr", 0.9)], "url string, html string, lang string, language_confidence double")
    assert [r["error"] for r in crawl.snapshots(pages).orderBy("url").collect()] == [None, "min_text_length", "language_allowlist"]
