"""Validation: rules, web evidence and a model vote on each concept.

Concepts: id, level, canonical_label, parents. Snapshots: snap (an order), institution, url, text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as tx
from ..policies import ValidationPolicy

#: Concepts whose labels are broadcast as one block to the evidence search; more go in further blocks.
LABEL_BLOCK = 20_000


def rules(concepts: DataFrame, policy: ValidationPolicy | None = None) -> DataFrame:
    """Adds rule: struct(passed, hard_fail, hard, soft, violations, summary)."""
    policy = policy or ValidationPolicy()
    label, level = F.col("canonical_label"), F.col("level")
    none = F.array().cast("array<string>")
    n = F.size(F.coalesce("parents", none))
    found: list[Column] = []
    if policy.structural_checks:
        found += [F.when((level == 0) & (n > 0), "root_has_parents"), F.when((level > 0) & (n == 0), "missing_parents"), F.when(~level.between(0, 3), "invalid_level")]
    found += [F.when(label.rlike(f"(?i){p}"), F.lit(f"forbidden_pattern:{p}")) for p in policy.forbidden_patterns]
    found += [F.when((level == 3) & label.rlike(f"(?i){p}"), F.lit(f"venue_name_detected:{p}")) for p in policy.venue_patterns]
    for k, words in policy.required_vocabularies.items():
        has_all = F.lit(True)
        for word in words:
            has_all = has_all & F.contains(F.lower(label), F.lit(word.lower()))
        found.append(F.when((level == int(k)) & ~has_all, F.lit(f"missing_required_vocab:{k}")))
    wide = concepts.select("*", F.filter(F.array(*found), lambda v: v.isNotNull()).alias("__all"))

    def soft(v: Column) -> Column:
        detail = F.regexp_replace(v, "^[^:]*:", "")
        return v.startswith("venue_name_detected:") & F.lit(not policy.venue_detection_hard) & ~F.array_contains("__all", F.concat(F.lit("forbidden_pattern:"), detail))

    wide = wide.select("*", F.filter("__all", lambda v: ~soft(v)).alias("__hard"), F.filter("__all", soft).alias("__soft"))
    hard, weak = F.size("__hard"), F.size("__soft")
    counts = F.concat_ws(", ", F.when(hard > 0, F.concat(hard.cast("string"), F.lit(" hard"))), F.when(weak > 0, F.concat(weak.cast("string"), F.lit(" soft"))))
    summary = F.when(hard + weak == 0, "Rule checks succeeded").otherwise(F.concat(counts, F.lit(" violations; most significant: "), F.coalesce(F.get("__hard", F.lit(0)), F.get("__soft", F.lit(0)))))
    made = F.struct((hard == 0).alias("passed"), (hard > 0).alias("hard_fail"), F.col("__hard").alias("hard"), F.col("__soft").alias("soft"), F.col("__all").alias("violations"), summary.alias("summary"))
    return wide.select(*concepts.columns, made.alias("rule"))


def rule_findings(judged: DataFrame) -> DataFrame:
    hard = F.transform("rule.hard", lambda v: F.concat(F.lit("Rule violation: "), v))
    soft = F.transform("rule.soft", lambda v: F.concat(F.lit("Rule warning: "), v))
    fine = F.array(F.lit("All deterministic rule checks passed."))
    detail = F.when(F.size("rule.violations") == 0, fine).otherwise(F.concat(hard, soft))
    return judged.select(F.col("id").alias("concept_id"), F.lit("rule").alias("mode"), (F.size("rule.violations") == 0).alias("passed"), F.explode(detail).alias("detail"))


def authority(url: Column, policy: ValidationPolicy) -> Column:
    host = tx.host_of(url)
    return F.when(tx.in_domain(host, policy.authoritative_domains), 1.0).when(host.endswith(".edu") | host.endswith(".gov"), 0.8).otherwise(0.3)


def mentions(concepts: DataFrame, snapshots: DataFrame, block: int = LABEL_BLOCK) -> DataFrame:
    """id, snap and the snapshot's columns: texts that hold a concept's label, without regard to case.

    The label is a substring, which may begin or end inside a word, so only its inner words and, for labels of one or two
    words, letters are certain. Labels of three words or more are found through their rarest inner word, an equi-join with
    the words of the texts; shorter ones are compared with each text in broadcast blocks of bounded size."""
    labels = concepts.select("id", F.lower("canonical_label").alias("low")).where("low <> ''")
    texts = snapshots.withColumn("__low", F.lower("text"))
    parts = F.split("low", "[^a-z0-9]+")
    inner = F.filter(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0))), lambda t: t != "")
    labels = labels.withColumn("inner", inner)
    long = labels.where(F.size("inner") > 0)
    seen = texts.select("snap", F.explode(F.array_distinct(F.split("__low", "[^a-z0-9]+"))).alias("word"))
    wanted = long.select(F.explode("inner").alias("word")).distinct()
    counts = seen.join(wanted, "word", "left_semi").groupBy("word").count()
    rare = long.select("id", "low", F.explode("inner").alias("word")).join(counts, "word").groupBy("id", "low").agg(F.min_by("word", F.struct("count", "word")).alias("word"), F.count("*").alias("n"))
    pairs = rare.select("id", "low", "word").join(seen, "word").select("id", "low", "snap")
    out = pairs.join(texts, "snap").where(F.contains("__low", F.col("low"))).select("id", *snapshots.columns)
    short = labels.where(F.size("inner") == 0).select("id", "low")
    total = short.count()
    for k in range(-(-total // block) if total else 0):
        some = short.where(F.pmod(F.xxhash64("id"), F.lit(-(-total // block))) == k) if total > block else short
        out = out.unionByName(texts.join(F.broadcast(some), F.contains(F.col("__low"), F.col("low"))).select("id", *snapshots.columns))
    return out


def snippets(concepts: DataFrame, found: DataFrame, policy: ValidationPolicy | None = None) -> DataFrame:
    """id, snap, at (place in the text, from 0), snippet, url, institution, score: every occurrence that does not overlap the
    one before it, with half of snippet_max_length on either side."""
    policy = policy or ValidationPolicy()
    half = policy.snippet_max_length // 2
    wide = found.join(concepts.select("id", F.lower("canonical_label").alias("low")), "id")
    pieces = F.split(F.lower("text"), F.concat(F.lit("\\Q"), F.col("low"), F.lit("\\E")), F.lit(-1))
    sizes = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), F.length)
    step = F.length("low")
    # a running sum of the pieces before each occurrence
    starts = F.aggregate(sizes, F.array().cast("array<int>"), lambda a, s: F.array_append(a, F.when(F.size(a) == 0, s).otherwise(F.element_at(a, -1) + step + s)))
    each = wide.select("id", "snap", "url", "institution", "text", step.alias("step"), F.col("low"), F.explode(starts).alias("at"))
    begin = F.greatest(F.lit(0), F.col("at") - half)
    said = tx.squeeze_ends(F.substring(F.col("text"), begin + 1, F.col("at") + F.col("step") + half - begin))
    low = F.lower(said)
    score = F.when(F.contains(low, F.col("low")), 1.0).otherwise(0.5) + F.when((F.coalesce("institution", F.lit("")) != "") & F.contains(low, F.lower("institution")), 0.2).otherwise(0.0) + 0.3 * authority(F.col("url"), policy)
    return each.select("id", "snap", "at", said.alias("snippet"), "url", "institution", F.least(F.lit(1.5), score).alias("score"))


def top_snippets(found: DataFrame, policy: ValidationPolicy | None = None) -> DataFrame:
    """The best max_snippets of each concept; rank from 1, ties by snapshot and place."""
    policy = policy or ValidationPolicy()
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("id").orderBy(F.desc("score"), "snap", "at")))
    return ranked.where(F.col("rank") <= max(0, policy.max_snippets))


def web(concepts: DataFrame, top: DataFrame, index_empty: bool = False, timed_out: bool = False, policy: ValidationPolicy | None = None) -> DataFrame:
    """Adds web: struct(passed, unknown, n, mean_score, top_url, top_institution, summary)."""
    policy = policy or ValidationPolicy()
    of = top.groupBy("id").agg(F.count("*").alias("n"), F.avg("score").alias("mean"), F.min_by(F.struct("url", "institution"), "rank").alias("first"))
    unknown = F.lit(bool(index_empty or timed_out))
    n = F.coalesce("n", F.lit(0))
    summary = F.when(unknown, F.lit("No evidence (timeout)" if timed_out else "No evidence (index empty)")).when(n == 0, "No evidence").otherwise(F.concat(F.lit("Evidence snippets: "), n.cast("string")))
    made = F.struct((~unknown & (n >= policy.min_snippet_matches)).alias("passed"), unknown.alias("unknown"), n.alias("n"), F.coalesce("mean", F.lit(0.0)).alias("mean_score"), F.col("first.url").alias("top_url"), F.col("first.institution").alias("top_institution"), summary.alias("summary"))
    return concepts.join(of, "id", "left").select(*concepts.columns, made.alias("web"))


def packed(top: DataFrame, policy: ValidationPolicy | None = None) -> DataFrame:
    """The snippets that a model sees: in rank order until the budget of four characters a token is passed, one at least."""
    policy = policy or ValidationPolicy()
    limit = policy.max_evidence_tokens * 4
    of = W.partitionBy("id").orderBy("rank").rowsBetween(W.unboundedPreceding, 0)
    filled = top.where("snippet <> ''").select("*", F.sum(F.length("snippet")).over(of).alias("__sum"), F.row_number().over(W.partitionBy("id").orderBy("rank")).alias("__n"))
    over = F.max(((F.col("__n") > 1) & (F.col("__sum") > limit)).cast("int")).over(of) if limit else F.lit(0)
    return filled.select("*", over.alias("__over")).where("__over = 0").drop("__sum", "__n", "__over")


def model(concepts: DataFrame, top: DataFrame, runner: Callable[[DataFrame], DataFrame], policy: ValidationPolicy | None = None) -> DataFrame:
    """Adds model: struct(passed, confidence, summary). The runner gets id, canonical_label, level, evidence (array of
    struct(text, url, institution)) and gives id, answer (JSON: pass or validated, confidence, reason). A concept without
    evidence or with a failed call votes against."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("rank", F.struct(F.col("snippet").alias("text"), "url", "institution").alias("e")))), lambda s: s["e"])
    payload = packed(top, policy).groupBy("id").agg(listed.alias("evidence"))
    quality = top.groupBy("id").agg(F.avg("score").alias("quality"))
    asked = concepts.select("id", "canonical_label", "level").join(payload, "id")
    answer = F.from_json("answer", "struct<pass:string,validated:string,confidence:string,reason:string>")
    answers = runner(asked).select("id", answer.alias("a"))
    wide = concepts.join(payload.select("id", F.lit(True).alias("__asked")), "id", "left").join(answers, "id", "left").join(quality, "id", "left")
    yes = F.lower(F.coalesce("a.pass", "a.validated", F.lit("false"))).isin("true", "1", "yes")
    sure = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.5 * F.coalesce(F.col("a.confidence").try_cast("double"), F.lit(0.0)) + 0.5 * F.least(F.lit(1.0), F.coalesce("quality", F.lit(0.0)))))
    ok = F.col("a").isNotNull()
    summary = F.when(F.col("__asked").isNull(), "No evidence").when(~ok, "Model call failed").when(yes, "Entailment passed").otherwise("Entailment failed")
    made = F.struct((ok & yes).alias("passed"), F.when(ok, sure).otherwise(0.0).alias("confidence"), summary.alias("summary"))
    return wide.select(*concepts.columns, made.alias("model"))


def vote(judged: DataFrame, policy: ValidationPolicy | None = None) -> DataFrame:
    """Adds decision: struct(passed, confidence, scores, rationale) from rule and, where the columns are there, web and model.

    A hard rule failure blocks. Otherwise more than half of the weights that took part must be for it; an unknown web result
    takes no part. A tie passes if ties are not conservative, or if the evidence is strong enough."""
    policy = policy or ValidationPolicy()
    rule = F.col("rule")
    zero = F.lit(0.0)
    total, mine = F.lit(policy.rule_weight), F.when(rule["passed"], policy.rule_weight).otherwise(0.0)
    web_score = model_score = web_strength = model_strength = zero
    parts = [rule["summary"]]
    if "web" in judged.columns:
        w = F.col("web")
        there = w.isNotNull() & ~F.coalesce(w["unknown"], F.lit(False))
        total = total + F.when(there, policy.web_weight).otherwise(0.0)
        web_score = F.when(there & w["passed"], policy.web_weight).otherwise(0.0)
        web_strength = F.when(there & (w["n"] > 0), w["mean_score"]).otherwise(0.0)
        parts.append(w["summary"])
    if "model" in judged.columns:
        m = F.col("model")
        total = total + F.when(m.isNotNull(), policy.model_weight).otherwise(0.0)
        model_score = F.when(m["passed"], policy.model_weight).otherwise(0.0)
        model_strength = F.when(m["passed"], m["confidence"]).otherwise(0.0)
        parts.append(m["summary"])
    votes = mine + web_score + model_score
    half = total / 2
    near = F.abs(votes - half) <= F.greatest(F.lit(1e-9), 1e-9 * F.greatest(F.abs(votes), F.abs(half)))
    tie = near & (total > 0)
    strength = policy.tie_break_min_strength if policy.tie_break_min_strength is not None else policy.confidence_threshold
    by_strength = F.greatest(web_strength, model_strength) >= strength if policy.tie_break_conservative else F.lit(True)
    passed = F.when(total <= 0, False).when(tie, by_strength).otherwise(votes > half)
    blocked = rule["hard_fail"] & F.lit(policy.hard_rule_failure_blocks)

    def unless(x: Column) -> Column:
        return F.when(blocked, 0.0).otherwise(x)

    said = F.when(blocked, F.concat_ws("; ", F.lit("Hard rule failure"), rule["summary"])).otherwise(F.concat_ws("; ", F.lit("Weighted aggregation"), *parts))
    made = F.struct((~blocked & passed).alias("passed"), unless(F.when(total > 0, votes / total).otherwise(0.0)).alias("confidence"), F.struct(unless(mine).alias("rule"), unless(web_score).alias("web"), unless(model_score).alias("model")).alias("scores"), said.alias("rationale"))
    return judged.select("*", made.alias("decision"))


def applied(judged: DataFrame) -> DataFrame:
    """Concepts with validation_passed and validation_metadata (JSON) of their decision."""
    d = F.col("decision")
    told = [d["scores"].alias("scores"), d["confidence"].alias("confidence"), d["rationale"].alias("rationale")]
    if "web" in judged.columns:
        told += [F.col("web.n").alias("evidence_count"), F.col("web.top_url").alias("top_url")]
    base = [c for c in judged.columns if c not in ("rule", "web", "model", "decision", "validation_passed", "validation_metadata")]
    return judged.select(*base, d["passed"].alias("validation_passed"), F.to_json(F.struct(*told)).alias("validation_metadata"))


