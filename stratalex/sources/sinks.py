"""Writers. Spark's commit protocol makes each output appear whole or not at all."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import hierarchy


def json_lines(df: DataFrame, path: str, compress: bool = False, batch: int | None = None, sort: list[str] | None = None, mode: str = "errorifexists") -> None:
    """JSON lines; `batch` bounds the rows of a file, `sort` orders rows over the files."""
    out = df.orderBy(*sort) if sort else df
    writer = out.write.mode(mode)
    if compress:
        writer = writer.option("compression", "gzip")
    if batch:
        writer = writer.option("maxRecordsPerFile", batch)
    writer.json(path)


def enveloped(df: DataFrame, path: str, extra: list[str] | None = None) -> None:
    """{candidate: {...}, institutions, record_fingerprints, ...}, ordered by level, normalized, parents."""
    fields = ["level", "label", "normalized", "parents", "aliases", "support"]
    order = ["level", "normalized", F.array_join("parents", "\u0001")]
    df.orderBy(*order).select(F.struct(*fields).alias("candidate"), "institutions", "record_fingerprints", *(extra or [])).write.json(path)


def split_by_pass(df: DataFrame, path: str) -> None:
    """Decisions in folders passed=true and passed=false."""
    df.write.partitionBy("passed").json(path)


def document(spark: SparkSession, payload: dict[str, Any], path: str) -> None:
    """One JSON file with sorted keys, through the file system of the path, written aside and renamed."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fresh = jvm.org.apache.hadoop.fs.Path(f"{path}.tmp")
    stream = fs.create(fresh, True)
    stream.write(json.dumps(payload, sort_keys=True, indent=2, default=str).encode())
    stream.close()
    if fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(fresh, target):
        raise OSError(f"cannot write {path}")


def read_document(spark: SparkSession, path: str) -> dict[str, Any] | None:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return json.loads(bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
    finally:
        stream.close()


def dedup_result(survivors: DataFrame, merges: DataFrame, stats: dict[str, Any], path: str) -> None:
    survivors.write.json(f"{path}/concepts")
    merges.write.json(f"{path}/merge_ops")
    document(survivors.sparkSession, stats, f"{path}/metadata.json")


def split_result(concepts: DataFrame, splits: DataFrame, deferred: DataFrame, stats: dict[str, Any], path: str) -> None:
    concepts.write.json(f"{path}/concepts")
    splits.write.json(f"{path}/split_ops")
    deferred.write.json(f"{path}/deferred")
    document(concepts.sparkSession, stats, f"{path}/metadata.json")


def validation_result(concepts: DataFrame, findings: DataFrame, evidence: DataFrame, stats: dict[str, Any], path: str) -> None:
    concepts.write.json(f"{path}/concepts")
    findings.write.json(f"{path}/findings")
    evidence.write.json(f"{path}/evidence")
    document(concepts.sparkSession, stats, f"{path}/metadata.json")


def graph(nodes: DataFrame, edges: DataFrame, path: str, form: str = "json") -> None:
    """Nodes and edges (json), adjacency lists (adjacency) or Graphviz lines (dot)."""
    if form == "json":
        nodes.orderBy("level", "id").write.json(f"{path}/nodes")
        edges.orderBy("parent", "child").write.json(f"{path}/edges")
    elif form == "adjacency":
        hierarchy.adjacency(nodes, edges).orderBy("id").write.json(path)
    elif form == "dot":
        hierarchy.dot_lines(nodes, edges).orderBy("line").write.text(path)
    else:
        raise ValueError(f"unknown graph form {form}")


def export(df: DataFrame, path: str, form: str = "csv", level: int | None = None) -> None:
    """Flat export with columns in name order; nested values as JSON text in CSV."""
    rows = df if level is None else df.where(F.col("level") == level)
    if form == "json":
        rows.select(*sorted(rows.columns)).write.json(path)
        return
    nested = {f.name for f in rows.schema if f.dataType.typeName() in ("struct", "array", "map")}
    rows.select(*[F.to_json(c).alias(c) if c in nested else F.col(c) for c in sorted(rows.columns)]).write.option("header", True).csv(path)


def quarantine(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)
