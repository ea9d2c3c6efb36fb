"""Orchestration: ordered phases with stored results, resuming, a bounded fixed point and a manifest."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..policies import Policies, flat
from ..sources import sinks
from ..sources.shared import cut
from .metrics import Run, canonical_json, redacted

LEVEL_PHASES = ("level_0", "level_1", "level_2", "level_3")
PHASES = (*LEVEL_PHASES, "consolidate", "post_process", "resume", "finalize")
MOST_ITERATIONS = 5


@dataclass
class Context:
    """State of a run: the stored table of each finished phase."""

    spark: SparkSession
    folder: str
    policies: Policies
    run: Run = field(default_factory=Run)
    tables: dict[str, DataFrame] = field(default_factory=dict)
    notes: dict[str, Any] = field(default_factory=dict)


Phase = Callable[[Context], DataFrame]


class Pipeline:
    """Runs phases in order. Each phase's table is stored under the run's folder with a record of its rows and time; a resumed
    run reads the tables of the phases before instead of making them again."""

    def __init__(self, phases: list[tuple[str, Phase]]):
        names = [n for n, _ in phases]
        if len(set(names)) != len(names):
            raise ValueError("phases need distinct names")
        self.phases = phases

    def _record(self, context: Context, name: str) -> str:
        return f"{context.folder}/phases/{name}.json"

    def last_finished(self, context: Context) -> str | None:
        done = None
        for name, _ in self.phases:
            if sinks.read_document(context.spark, self._record(context, name)) is None:
                break
            done = name
        return done

    def execute(self, context: Context, resume_from: str | None = None, resume: bool = False) -> DataFrame:
        names = [n for n, _ in self.phases]
        if resume_from is not None and resume_from not in names:
            raise KeyError(f"no phase {resume_from}; known: {names}")
        first = names.index(resume_from) if resume_from else 0
        if resume and resume_from is None and (last := self.last_finished(context)):
            first = names.index(last) + 1
        out = None
        for k, (name, phase) in enumerate(self.phases):
            record = sinks.read_document(context.spark, self._record(context, name)) if k < first else None
            if record is not None:
                out = context.spark.read.parquet(record["path"])
                context.tables[name] = out
                continue
            began = time.time()
            made = phase(context)
            path = f"{context.folder}/tables/{name}-{int(began * 1000)}"
            made.write.parquet(path)
            out = context.spark.read.schema(made.schema).parquet(path)
            context.tables[name] = out
            rows, seconds = out.count(), time.time() - began
            context.run.performance[name] = {"seconds": seconds, "items": rows}
            context.run.log(name, "phase", rows=rows)
            sinks.document(context.spark, {"phase": name, "path": path, "rows": rows, "seconds": seconds}, self._record(context, name))
        return out


def fixed_point(table: DataFrame, steps: list[Callable[[DataFrame], DataFrame]], most: int = MOST_ITERATIONS) -> tuple[DataFrame, int, bool]:
    """(table, iterations, converged): the steps in turn until none changes the table, at most `most` times."""

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64(F.to_json(F.struct(*df.columns))).cast("decimal(20,0)"))).first())

    before = mark(table)
    for k in range(1, most + 1):
        for step in steps:
            table = step(table)
        table = cut(table, "iteration")
        now = mark(table)
        if now == before:
            return table, k, True
        before = now
    return table, most, False


def remove_old(spark: SparkSession, folder: str, keep: int = 3, dry_run: bool = False) -> list[str]:
    """Removes all but the newest tables of each phase; gives their paths."""
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(f"{folder}/tables")
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    by_phase: dict[str, list[str]] = {}
    for s in fs.listStatus(base):
        name = s.getPath().getName()
        by_phase.setdefault(name.rpartition("-")[0], []).append(name)
    gone = [n for names in by_phase.values() for n in sorted(names, key=lambda n: int(n.rpartition("-")[2]))[: -keep or None]]
    if not dry_run:
        for name in gone:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{folder}/tables/{name}"), True)
    return sorted(gone)


def manifest(context: Context, seeds: dict[str, int] | None = None) -> dict[str, Any]:
    """Versions, settings, thresholds, seeds, statistics and a checksum of a run; secrets are redacted."""
    settings = redacted(flat(context.policies), context.policies.observability.redacted_keys)
    body = {
        "versions": {"spark": context.spark.version, "policies": context.policies.version},
        "settings": settings,
        "thresholds": {str(k): {"min_institutions": t.min_institutions, "min_src_count": t.min_src_count} for k, t in enumerate(context.policies.frequency.thresholds)},
        "seeds": seeds or {"sampling": context.policies.observability.seed, "spreadsheet": context.policies.spreadsheet.seed},
        "statistics": context.run.snapshot(),
        "notes": redacted(context.notes, context.policies.observability.redacted_keys),
    }
    stable = {k: v for k, v in body.items() if k != "statistics"}
    return body | {"checksum": hashlib.sha256(canonical_json(stable).encode()).hexdigest()}


def finish(context: Context) -> dict[str, Any]:
    made = manifest(context)
    sinks.document(context.spark, made, f"{context.folder}/run_manifest.json")
    return made
