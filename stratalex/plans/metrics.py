"""Counters, evidence samples, quarantine and model metrics of a run."""

from __future__ import annotations

import json
import threading
from collections import deque
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..policies import ObservabilityPolicy

# Counters of each phase.
COUNTERS = {
    "S0": ("pages_seen", "pages_emitted", "pages_failed", "blocks_total", "blocks_kept", "by_language"),
    "S1": ("records_in", "candidates_out", "invalid_json", "quarantined"),
    "S2": ("candidates_in", "kept", "dropped_insufficient_support"),
    "S3": ("checked", "passed_rule", "failed_rule", "model_calls", "allowlist_hits"),
    "dedup": ("pairs_compared", "edges_kept", "merges"),
    "disambiguation": ("collisions_detected", "splits_made", "deferred"),
    "validation": ("checked", "rule_failed", "web_failed", "model_called", "passed_all"),
    "hierarchy": ("nodes", "edges", "orphans", "violations"),
}


class Counters:
    """Counters of known phases and names; labelled ones count by a further key."""

    def __init__(self) -> None:
        self.values: dict[tuple[str, str, str], int] = {}
        self.lock = threading.RLock()

    def add(self, phase: str, name: str, n: int = 1, label: str = "") -> None:
        if phase not in COUNTERS or name not in COUNTERS[phase]:
            raise KeyError(f"no counter {phase}.{name}")
        if n < 0:
            raise ValueError("counters only grow")
        with self.lock:
            self.values[phase, name, label] = self.values.get((phase, name, label), 0) + n

    def add_row(self, phase: str, row: dict[str, Any]) -> None:
        for name, n in row.items():
            if name in COUNTERS.get(phase, ()):
                self.add(phase, name, int(n or 0))

    def snapshot(self) -> dict[str, dict[str, Any]]:
        out: dict[str, dict[str, Any]] = {p: {n: 0 for n in names} for p, names in COUNTERS.items()}
        for (phase, name, label), n in sorted(self.values.items()):
            if label:
                at = out[phase][name]
                out[phase][name] = (at if isinstance(at, dict) else {}) | {label: n}
            else:
                out[phase][name] = n
        return out


def observed(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """Counts rows as they pass, without a job of their own."""
    seen = Observation()
    return df.observe(seen, *[c.alias(n) for n, c in counts.items()]), seen


def sample(rows: DataFrame, phase: str, key: Column, policy: ObservabilityPolicy = ObservabilityPolicy(), weight: Column | None = None) -> DataFrame:
    """At most max_samples rows: those whose seeded hash falls under the rate (times a weight), least hashes first. The same
    rows are chosen in any order and partitioning."""
    resolution = 1 << 30
    hashed = F.pmod(F.xxhash64(key.cast("string"), F.lit(phase), F.lit(policy.seed)), F.lit(resolution))
    rate = F.least(F.lit(1.0), F.lit(policy.sampling_rate) * (weight if weight is not None else F.lit(1.0)))
    return rows.withColumn("__h", hashed).where(F.col("__h") < rate * resolution).orderBy("__h").limit(policy.max_samples).drop("__h")


def stratified_split(rows: DataFrame, stratum: str, key: str, share: float, seed: int = 0) -> DataFrame:
    """Adds held_out: in each stratum the share with the least seeded hashes, one at least on either side where there are two."""
    of = W.partitionBy(stratum)
    n, rank = F.count("*").over(of), F.row_number().over(of.orderBy(F.xxhash64(F.col(key).cast("string"), F.lit(seed)), key))
    take = F.greatest(F.lit(1), F.least(n - 1, F.round(n * share)))
    return rows.withColumn("held_out", F.when(n < 2, False).otherwise(rank <= take))


def quarantine_counts(bad: DataFrame, reason: str = "error") -> DataFrame:
    return bad.groupBy(F.col(reason).alias("reason")).agg(F.count("*").alias("items"))


def call_metrics(calls: DataFrame, last: int = 200) -> DataFrame:
    """One row for calls (at, ok, latency_ms, tokens): counts, and the median, p95 and tokens of the last ones. p95 is the value at
    place floor(0.95 * (n - 1)) of the sorted latencies."""
    recent = calls.orderBy(F.desc("at")).limit(last)
    ordered = F.array_sort(F.collect_list("latency_ms"))
    tail = recent.agg(F.median("latency_ms").alias("p50_ms"), ordered.alias("all"), F.sum("tokens").alias("tokens"))
    tail = tail.select("p50_ms", F.get("all", F.floor(0.95 * (F.size("all") - 1)).cast("int")).alias("p95_ms"), "tokens")
    return calls.agg(F.count("*").alias("calls"), F.count_if("ok").alias("succeeded"), F.count_if(~F.col("ok")).alias("failed")).crossJoin(tail)


def canonical_json(value: Any) -> str:
    """The same text for equal values: keys and sets in order."""

    def plain(x: Any) -> Any:
        if isinstance(x, dict):
            return {str(k): plain(x[k]) for k in sorted(x, key=str)}
        if isinstance(x, (set, frozenset)):
            return sorted((plain(v) for v in x), key=str)
        if isinstance(x, (list, tuple)):
            return [plain(v) for v in x]
        return x if isinstance(x, (str, int, float, bool, type(None))) else str(x)

    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"))


def redacted(value: Any, keys: tuple[str, ...]) -> Any:
    if isinstance(value, dict):
        return {k: "<redacted>" if any(r in str(k).lower() for r in keys) else redacted(v, keys) for k, v in value.items()}
    return [redacted(v, keys) for v in value] if isinstance(value, list) else value


class Run:
    """What a run records on the driver: counters, a bounded log of operations, thresholds and seeds."""

    def __init__(self, policy: ObservabilityPolicy = ObservabilityPolicy()):
        self.policy, self.counters = policy, Counters()
        self.operations: deque = deque(maxlen=policy.max_operations)
        self.thresholds: dict[str, Any] = {}
        self.performance: dict[str, dict[str, float]] = {}

    def log(self, phase: str, operation: str, **details: Any) -> None:
        self.operations.append({"n": len(self.operations), "phase": phase, "operation": operation, "details": redacted(details, self.policy.redacted_keys)})

    def snapshot(self) -> dict[str, Any]:
        import hashlib

        body = {"counters": self.counters.snapshot(), "operations": list(self.operations), "thresholds": self.thresholds, "performance": self.performance, "seed": self.policy.seed}
        return body | {"checksum": hashlib.sha256(canonical_json(body).encode()).hexdigest()}
