"""Token verification: rules first, a model only for single tokens that rules leave open.

Input rows: level, label, normalized, aliases, rationale and what else a decision carries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..policies import LabelPolicy, TokenPolicy

# How a model may say yes or no.
PASS_KEYS = ("pass", "passed", "ok", "success")
YES = ("true", "1", "yes", "y", "on", "pass", "passed", "ok", "success")
NO = ("false", "0", "no", "n", "off", "fail", "failed", "failure")


def token_count(label: Column, policy: TokenPolicy) -> Column:
    prepared = label if policy.hyphenated_compounds_allowed else F.replace(label, F.lit("-"), F.lit(" "))
    return F.size(F.filter(F.split(tx.squeeze(prepared), " "), lambda t: t != ""))


def forbidden_marks(label: Column, policy: TokenPolicy) -> Column:
    marks = F.array(*[F.lit(m) for m in sorted(policy.forbidden_punctuation)]).cast("array<string>")
    return F.filter(marks, lambda m: F.contains(label, m))


def alnum_ratio(label: Column) -> Column:
    material = F.replace(label, F.lit(" "), F.lit(""))
    return F.when(material == "", F.lit(0.0)).otherwise(F.length(F.regexp_replace(material, r"[^\p{L}\p{N}]", "")) / F.length(material))


def venue_hit(label: Column, level: Column, policy: TokenPolicy) -> Column:
    """The venue or keyword found in a level 3 label; else null."""
    if not policy.venue_names_forbidden:
        return F.lit(None).cast("string")
    low = F.lower(tx.squeeze(label))
    tight = F.regexp_replace(low, "[ -]", "")
    names = [" ".join(n.split()).lower() for n in policy.venue_names if n]
    compact = [n.replace(" ", "").replace("-", "") for n in names]
    hit = F.when(low.isin(*names) | tight.isin(*compact), low)
    for name, short in zip(names, compact):
        hit = hit.when(tight.startswith(short) & F.substring(tight, len(short) + 1, 1 << 30).rlike(r"^\p{Nd}*$"), F.lit(name))
    for keyword in policy.venue_keywords:
        hit = hit.when(F.contains(low, F.lit(keyword)), F.lit(keyword))
    return F.when(level == 3, hit)


def suggestions(label: Column, policy: TokenPolicy) -> Column:
    bare = label
    for mark in policy.forbidden_punctuation:
        bare = F.replace(bare, F.lit(mark), F.lit(" "))
    bare = tx.squeeze(bare)
    spaced = F.when(F.contains(label, F.lit("-")), F.replace(label, F.lit("-"), F.lit(" "))) if not policy.hyphenated_compounds_allowed else F.lit(None).cast("string")
    condensed = tx.squeeze(F.regexp_replace(label, "[^A-Za-z0-9 ]+", ""))
    first = F.filter(F.array(F.when((bare != "") & (bare != label), bare), spaced), lambda s: s.isNotNull())
    last = F.when((condensed != "") & (condensed != label) & ~F.array_contains(first, condensed), F.array(condensed)).otherwise(F.array().cast("array<string>"))
    return F.slice(F.concat(first, last), 1, 3)


def evaluate(candidates: DataFrame, policy: TokenPolicy = TokenPolicy(), form: LabelPolicy = LabelPolicy()) -> DataFrame:
    """Adds rule_evaluation: struct(passed, allowlist_hit, token_count, checks, reasons, suggestions)."""
    label, level = tx.squeeze("normalized"), F.col("level")
    limit = F.coalesce(*[F.when(level == k, F.lit(n)) for k, n in enumerate(policy.max_tokens)], F.lit(max(policy.max_tokens)))
    wide = candidates.select("*", label.alias("__label"), F.lower(label).isin(*[a.lower() for a in policy.allowlist]).alias("__allowed"), token_count(label, policy).alias("__n"), limit.alias("__limit"))
    label = F.col("__label")
    wide = wide.select("*", forbidden_marks(label, policy).alias("__marks"), alnum_ratio(label).alias("__ratio"), venue_hit(label, level, policy).alias("__venue"))
    checks = {
        "token_limit": (F.col("__n") <= F.col("__limit"), F.format_string("token_count %d exceeds max %d", "__n", "__limit")),
        "punctuation": (F.size("__marks") == 0, F.concat(F.lit("forbidden punctuation: "), F.array_join("__marks", ", "))),
        "length_bounds": (F.length(label).between(form.min_length, form.max_length), F.lit(f"length outside range {form.min_length}-{form.max_length}")),
        "alnum_ratio": (F.col("__ratio") >= policy.min_alnum_ratio, F.format_string(f"alphanumeric ratio %.2f below {policy.min_alnum_ratio:.2f}", "__ratio")),
        "venue": (F.col("__venue").isNull(), F.concat(F.lit("contains venue keyword '"), F.col("__venue"), F.lit("'"))),
    }
    all_right = None
    for ok, _ in checks.values():
        all_right = ok if all_right is None else all_right & ok
    reasons = F.filter(F.array(*[F.when(~ok, why) for ok, why in checks.values()]), lambda r: r.isNotNull())
    none = F.array().cast("array<string>")
    allowed = F.col("__allowed")
    evaluation = F.struct(
        (allowed | all_right).alias("passed"),
        allowed.alias("allowlist_hit"),
        F.col("__n").alias("token_count"),
        F.when(allowed, F.create_map(F.lit("allowlist"), F.lit(True))).otherwise(F.create_map(*[x for name, (ok, _) in checks.items() for x in (F.lit(name), ok)])).alias("checks"),
        F.when(allowed, F.array(F.lit("label matched allowlist"))).otherwise(reasons).alias("reasons"),
        F.when(~allowed & ~all_right, suggestions(label, policy)).otherwise(none).alias("suggestions"),
    )
    return wide.select(*candidates.columns, evaluation.alias("rule_evaluation"))


def parse_answer(answer: Column) -> Column:
    """struct(passed, reason, error) of a model's JSON answer: flags, words and numbers are understood, NaN and others say no."""
    parsed = F.from_json(answer, "map<string,string>")
    raw = F.coalesce(*[F.when(F.map_contains_key(parsed, F.lit(k)), F.coalesce(F.element_at(parsed, F.lit(k)), F.lit(""))) for k in PASS_KEYS])
    said = F.lower(F.trim(raw))
    number = said.try_cast("double")
    passed = F.when(said.isin(*YES), True).when(said.isin(*NO), False).otherwise(F.coalesce(number.isNotNull() & ~F.isnan(number) & (number != 0), F.lit(False)))
    reason = F.coalesce(F.nullif(F.element_at(parsed, F.lit("reason")), F.lit("")), F.when(passed, "pass").otherwise("fail"))
    broken = parsed.isNull()
    return F.struct((~broken & passed).alias("passed"), F.when(broken, "unexpected-payload").otherwise(reason).alias("reason"), F.when(broken, "the answer is no JSON object").alias("error"))


def decide(evaluated: DataFrame, runner: Callable[[DataFrame], DataFrame], policy: TokenPolicy = TokenPolicy()) -> DataFrame:
    """Adds model (struct or null), passed and the gates and reasons of the rationale; suggestions of passed rows become aliases.

    runner: gets the distinct (normalized, level) that need an answer, gives them back with answer (JSON string)."""
    e = F.col("rule_evaluation")
    single = (e["token_count"] <= 1) & ~e["allowlist_hit"] & ((e["token_count"] == 1) | ~e["passed"])
    asked = evaluated.where(single).select("normalized", "level").distinct()
    answers = runner(asked).select("normalized", "level", parse_answer(F.col("answer")).alias("model"))
    return settle(evaluated.join(answers, ["normalized", "level"], "left"), policy)


def settle(answered: DataFrame, policy: TokenPolicy = TokenPolicy()) -> DataFrame:
    """answered: evaluated rows with model (null where none was asked)."""
    e, m = F.col("rule_evaluation"), F.col("model")
    many = e["token_count"] > 1
    by_rule = F.when(~e["passed"], False).otherwise(F.coalesce(m["passed"], F.lit(True)))
    by_model = F.coalesce(m["passed"], e["passed"])
    passed = F.when(many | e["allowlist_hit"], True).otherwise(by_rule if policy.prefer_rule_over_model else by_model)
    old, none = F.col("rationale"), F.array().cast("array<string>")
    gates = F.map_from_arrays(F.array(F.lit("token_rule"), F.lit("token_llm"), F.lit("token_verification")), F.array(many | e["passed"], F.when(many, F.lit(None).cast("boolean")).otherwise(m["passed"]), passed))
    kept = F.map_filter(F.coalesce(old["passed_gates"], F.map_from_arrays(none, F.array().cast("array<boolean>"))), lambda k, v: ~k.isin("token_rule", "token_llm", "token_verification"))
    said = F.when(many, F.array(F.lit("bypass:multi_token"))).otherwise(F.concat(F.transform(e["reasons"], lambda r: F.concat(F.lit("rule:"), r)), F.transform(e["suggestions"], lambda r: F.concat(F.lit("suggestion:"), r)), F.filter(F.array(F.concat(F.lit("llm:"), m["reason"]), F.concat(F.lit("llm_error:"), m["error"])), lambda r: r.isNotNull())))
    limit = F.coalesce(*[F.when(F.col("level") == k, F.lit(float(n))) for k, n in enumerate(policy.max_tokens)], F.lit(float(max(policy.max_tokens))))
    thresholds = F.map_concat(F.map_filter(F.coalesce(old["thresholds"], F.map_from_arrays(none, F.array().cast("array<double>"))), lambda k, v: k != "token_limit"), F.create_map(F.lit("token_limit"), limit))
    rationale = F.struct(F.map_concat(kept, gates).alias("passed_gates"), F.concat(F.coalesce(old["reasons"], none), said).alias("reasons"), thresholds.alias("thresholds"))
    suggested = passed & (F.size(e["suggestions"]) > 0)
    names = F.array_sort(F.array_distinct(F.filter(F.transform(F.concat(F.coalesce("aliases", none), F.array("label"), e["suggestions"]), tx.squeeze), lambda a: a != "")))
    rest = [c for c in answered.columns if c not in ("rationale", "aliases", "passed")]
    evaluation = F.when(many, e.withField("passed", F.lit(True))).otherwise(e)
    return answered.select(*[evaluation.alias(c) if c == "rule_evaluation" else F.col(c) for c in rest], F.when(suggested, names).otherwise(F.col("aliases")).alias("aliases"), rationale.alias("rationale"), passed.alias("passed"))


def statistics(decided: DataFrame) -> DataFrame:
    e = F.col("rule_evaluation")
    return decided.agg(
        F.count("*").alias("checked"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.count_if(e["allowlist_hit"]).alias("allowlisted"),
        F.count_if(e["token_count"] > 1).alias("multi_token"),
        F.count_if(F.col("model").isNotNull()).alias("model_called"),
        F.count_if(F.col("model.passed")).alias("model_passed"),
        F.count_if(F.col("model.error").isNotNull()).alias("model_errors"),
    )


def promote(decided: DataFrame) -> DataFrame:
    """Concepts of the passed candidates. id: L{level}:{normalized}, with a hash of the parents where labels repeat."""
    named = decided.where("passed").select("*", F.concat(F.lit("L"), F.col("level").cast("string"), F.lit(":"), F.lower(tx.squeeze("normalized"))).alias("base"), F.array_join("parents", "|").alias("lineage"))
    many = named.groupBy("base").agg(F.min("lineage").alias("lo"), F.max("lineage").alias("hi")).select("base", (F.col("lo") != F.col("hi")).alias("many"))
    id_ = F.when(F.col("many"), F.concat("base", F.lit("@"), F.left(F.sha1(F.col("lineage").cast("binary")), F.lit(8)))).otherwise(F.col("base"))
    places = F.to_json(F.struct(F.col("institutions").alias("institutions")))
    parents = F.transform("parents", lambda p: F.regexp_replace(p, "^l([0-3]):", "L$1:"))  # grouping lower-cases ids of parents
    return named.join(many, "base").select(id_.alias("id"), "level", F.col("label").alias("canonical_label"), parents.alias("parents"), "aliases", "support", "rationale", F.lit(None).cast("boolean").alias("validation_passed"), places.alias("validation_metadata"))
