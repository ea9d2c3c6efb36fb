"""Audit runs: stages in turn over a bounded number of rows, with timings, quality counts and recommendations."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import cut
from . import evaluate

Stage = tuple[str, Callable[[DataFrame], DataFrame], dict[str, Column]]


def run(first: DataFrame, stages: list[Stage], limit: int = 10, order: str | None = None, baseline: dict[str, float] | None = None) -> dict:
    """first: the input, of which `limit` rows are used (by `order`, or by a hash of the row). Each stage's output is stored and
    checked. Gives timing, quality, recommendations and, with a baseline of seconds by stage, deltas."""
    if limit <= 0:
        raise ValueError("the limit must be positive")
    key = F.col(order) if order else F.xxhash64(*first.columns)
    table = cut(first.orderBy(key).limit(limit), "audit")
    times, counts, advice = [], {}, {}
    for name, stage, checks in stages:
        began = time.time()
        table = cut(stage(table), f"audit-{name}")
        seconds = time.time() - began
        counts[name] = {r["issue"]: r["rows"] for r in evaluate.quality(table, checks).collect()} if checks else {"<rows>": table.count()}
        times.append((name, seconds, counts[name].get("<rows>", 0)))
        advice[name] = evaluate.recommendations(counts[name])
    spark = first.sparkSession
    timing = evaluate.timing(spark.createDataFrame(times, "stage string, seconds double, items long"))
    out = {"timing": [r.asDict() for r in timing.collect()], "quality": counts, "recommendations": advice}
    if baseline:
        out["deltas"] = {n: s - baseline[n] for n, s, _ in times if n in baseline}
    return out
