"""Evaluation and audits: set F1 with guardrails, quality of stage outputs, timings, deltas to a baseline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def set_f1(rows: DataFrame, expected: str, found: str, guardrails: Column | None = None) -> DataFrame:
    """Adds precision, recall, f1 of two arrays as sets of trimmed lower-case labels; all 0 where a guardrail is broken."""

    def clean(c: str) -> Column:
        return F.array_distinct(F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.lower(F.trim(x))), lambda x: x != ""))

    wide = rows.select("*", clean(expected).alias("__e"), clean(found).alias("__f"))
    hit, e, f = F.size(F.array_intersect("__e", "__f")), F.size("__e"), F.size("__f")
    precision = F.when(f == 0, F.when(e == 0, 1.0).otherwise(0.0)).otherwise(hit / f)
    recall = F.when(e == 0, F.when(f == 0, 1.0).otherwise(0.0)).otherwise(hit / e)
    wide = wide.select(*rows.columns, precision.alias("precision"), recall.alias("recall"))
    both = F.col("precision") + F.col("recall")
    wide = wide.withColumn("f1", F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(0.0))
    if guardrails is None:
        return wide
    return wide.withColumns({c: F.when(guardrails, F.col(c)).otherwise(0.0) for c in ("precision", "recall", "f1")})


def mean_scores(scored: DataFrame, *by: str) -> DataFrame:
    return scored.groupBy(*by).agg(F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), F.count("*").alias("examples"))


def json_validity(answers: DataFrame, schema: str) -> DataFrame:
    """valid_rate and schema_rate of JSON answers."""
    return answers.agg(F.avg(F.try_parse_json("answer").isNotNull().cast("double")).alias("valid_rate"), F.avg(F.from_json("answer", schema).isNotNull().cast("double")).alias("schema_rate"))


def quality(rows: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """issue, rows: how many rows break each check, and how many rows there are (issue null)."""
    broken = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]), lambda x: x.isNotNull())
    each = rows.select(F.explode(F.array_append(broken, F.lit("<rows>"))).alias("issue"))
    return each.groupBy("issue").agg(F.count("*").alias("rows"))


def timing(stages: DataFrame, target: int | None = None) -> DataFrame:
    """Adds share, per_second, bottleneck and, for a target of items, projected seconds to stages (stage, seconds, items)."""
    every = W.partitionBy(F.lit(1))  # a run has a handful of stages
    total, most = F.sum("seconds").over(every), F.max("seconds").over(every)
    out = stages.select("*", F.when(total > 0, F.col("seconds") / total).otherwise(0.0).alias("share"), F.when(F.col("seconds") > 0, F.col("items") / F.col("seconds")).alias("per_second"), (F.col("seconds") == most).alias("bottleneck"))
    return out if target is None else out.withColumn("projected", F.when(F.col("items") > 0, F.col("seconds") * target / F.col("items")))


def compared(now: DataFrame, baseline: DataFrame, key: str, value: str) -> DataFrame:
    """key, now, before, delta, ratio."""
    before = baseline.select(key, F.col(value).alias("before"))
    return now.select(key, F.col(value).alias("now")).join(before, key, "full_outer").select(key, "now", "before", (F.col("now") - F.col("before")).alias("delta"), F.when(F.col("before") != 0, F.col("now") / F.col("before")).alias("ratio"))


def recommendations(quality_counts: dict[str, int], most_share: float = 0.05) -> list[str]:
    """Issues that more than a share of the rows have, worst first."""
    total = quality_counts.get("<rows>", 0)
    worst = sorted(((n, i) for i, n in quality_counts.items() if i != "<rows>" and total and n / total > most_share), reverse=True)
    return [f"{issue}: {n} of {total} rows" for n, issue in worst]


def lever_grid(few_shot: tuple[int, ...] = (0, 2, 4), temperatures: tuple[float, ...] = (0.0, 0.2), constraints: tuple[str, ...] = ("baseline", "guarded", "compact")) -> list[dict]:
    """Settings to try for a prompt, each once."""
    return [{"few_shot": k, "temperature": t, "constraint": c} for k in few_shot for t in temperatures for c in constraints]


def best_setting(scores: list[tuple[dict, dict]], valid: float = 0.995, schema: float = 1.0) -> dict | None:
    """Of (setting, metrics) that keep the validity thresholds, the one of the greatest f1, then precision, then recall."""
    fit = [(m["f1"], m["precision"], m["recall"], -i, s) for i, (s, m) in enumerate(scores) if m.get("valid_rate", 1) >= valid and m.get("schema_rate", 1) >= schema]
    return max(fit, key=lambda x: x[:4])[4] if fit else None
