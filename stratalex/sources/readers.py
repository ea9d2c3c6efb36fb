"""Readers of the stages' files. Every reader takes its schema from `schemas`; malformed rows go to a quarantine table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import text as tx

CORRUPT = "_corrupt"


def json_lines(spark: SparkSession, paths: str | list[str], schema: str, pattern: str = "*.jsonl*") -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of JSON lines in files or, recursively, folders. Blank lines are skipped; rows carry source_file."""
    paths = [paths] if isinstance(paths, str) else paths
    full = T._parse_datatype_string(schema).add(CORRUPT, T.StringType())
    reader = spark.read.option("recursiveFileLookup", True)
    if not all(p.endswith((".jsonl", ".jsonl.gz", ".json")) for p in paths):
        reader = reader.option("pathGlobFilter", pattern)
    lines = reader.text(paths).where(F.trim("value") != "").select("value", F.col("_metadata.file_path").alias("source_file"))
    rows = lines.select(F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r"), "value", "source_file")
    broken = F.col(f"r.{CORRUPT}").isNotNull() | F.col("r").isNull()
    bad = rows.where(broken).select("source_file", F.col("value").alias("raw"), F.lit("malformed-json").alias("error"))
    return rows.where(~broken).select("r.*", "source_file").drop(CORRUPT), bad


def snapshots(spark: SparkSession, paths: str | list[str], institution: str | None = None, min_status: int = 200, max_status: int = 299, pattern: str = "*.jsonl*") -> tuple[DataFrame, DataFrame]:
    """(snapshots, quarantine). Lines are flat or {snapshot: {...}, language_confidence: ...}; broken constraints go to quarantine."""
    inner = "struct<" + ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in T._parse_datatype_string(schemas.SNAPSHOT)) + ">"
    rows, bad = json_lines(spark, paths, f"snapshot {inner}, language_confidence double, {schemas.SNAPSHOT}", pattern)
    names = [f.name for f in T._parse_datatype_string(schemas.SNAPSHOT)]
    flat = rows.select(*[F.coalesce(F.col(f"snapshot.{n}"), F.col(n)).alias(n) for n in names], "language_confidence", "source_file")
    good, broken = validated_snapshots(flat)
    keep = F.col("http_status").between(min_status, max_status)
    if institution:
        keep = keep & (F.col("institution") == institution)
    return good.where(keep), bad.unionByName(broken)


def snapshot_error(checked_checksum: bool = True) -> Column:
    """The first broken constraint of a snapshot; null if none is."""
    text = F.coalesce("text", F.lit(""))
    checks = [
        (F.coalesce(tx.squeeze("institution"), F.lit("")) == "", "institution is empty"),
        (tx.normalize_url(F.col("url")).isNull(), "url is no http(s) URL"),
        (~F.coalesce(F.col("http_status").between(100, 599), F.lit(False)), "http_status is outside 100 to 599"),
        (~F.contains(F.coalesce("content_type", F.lit("")), F.lit("/")), "content_type has no slash"),
        (~F.coalesce(F.lower("lang").rlike(r"^[a-z0-9-]{2,35}$"), F.lit(False)), "lang is no language tag"),
        (F.col("checksum").isNotNull() & (F.col("checksum") != tx.checksum(text)) if checked_checksum else F.lit(False), "checksum does not match the text"),
    ]
    return F.coalesce(*[F.when(c, F.lit(why)) for c, why in checks])


def validated_snapshots(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    judged = rows.withColumn("error", snapshot_error())
    bad = judged.where("error is not null").select(F.coalesce("source_file", F.lit("")).alias("source_file"), F.to_json(F.struct("url", "institution")).alias("raw"), "error")
    good = judged.where("error is null").drop("error").withColumn("canonical_url", F.coalesce("canonical_url", "url"))
    return good, bad


def source_records(spark: SparkSession, paths: str | list[str], level: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine); with a level, those whose hints name it or none."""
    rows, bad = json_lines(spark, paths, schemas.SOURCE_RECORD)
    rows = rows.withColumn("text", tx.squeeze_ends("text")).where("text <> ''")
    if level is not None:
        told = F.coalesce(F.col("meta.hints")["level"], F.col("meta.hints")["target_level"]).try_cast("int")
        rows = rows.where(told.isNull() | (told == level))
    return rows, bad


_DETAIL = "struct<institution:string,institutions:string,record_fingerprints:string,fingerprints:string,records:string>"
_PLACES = "institutions string, supporting_institutions string, support_details string, provenance string, record_fingerprints string, fingerprints string, records string"


def _listed(raw: Column) -> Column:
    """Strings of a JSON field that holds a list, or one string; null for anything else."""
    held = F.trim(raw)
    return F.when(F.startswith(held, F.lit("[")), F.from_json(held, "array<string>")).when((held != "") & ~F.startswith(held, F.lit("{")), F.array(held))


def _structs(raw: Column, kind: str) -> Column:
    """Structs of a JSON field that holds an object or a list of them."""
    held = F.trim(raw)
    return F.when(F.startswith(held, F.lit("[")), F.from_json(held, f"array<{kind}>")).when(F.startswith(held, F.lit("{")), F.array(F.from_json(held, kind)))


def evidence(spark: SparkSession, paths: str | list[str], level: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(candidates with evidence, quarantine). A line is {candidate: {...}, institutions: [...], ...} or a bare candidate; names
    of institutions and fingerprints are gathered from all the places where they may stand, as lists, strings or objects.
    `ord` numbers lines in the order of the files as they are read."""
    fields = T._parse_datatype_string(schemas.CANDIDATE_FIELDS)
    inner = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in fields)
    places = _PLACES.replace(" string", ":string").replace(", ", ",")
    rows, bad = json_lines(spark, paths, f"candidate struct<{inner},{places}>, {schemas.CANDIDATE_FIELDS}, {_PLACES}")
    none = F.array().cast("array<string>")
    flat = [F.coalesce(F.col(f"candidate.{f.name}"), F.col(f.name)).alias(f.name) for f in fields]

    def gathered(clean: Callable[[Column], Column], *places: Column) -> Column:
        every = F.transform(F.concat(*[F.coalesce(p, none) for p in places]), clean)
        return F.array_sort(F.array_distinct(F.filter(every, lambda x: x.isNotNull() & (x != ""))))

    def of(field: str) -> list[Column]:
        return [F.col(field), F.col(f"candidate.{field}")]

    def inside(column: Column, *names: str) -> list[Column]:
        """Lists in objects, whatever their number."""
        return [F.flatten(F.transform(_structs(column, _DETAIL), lambda d: F.coalesce(_listed(d[n]), none))) for n in names]

    told = [_listed(c) for f in ("institutions", "supporting_institutions") for c in of(f)]
    told += [x for c in of("support_details") for x in inside(c, "institutions", "institution")] + [x for c in of("provenance") for x in inside(c, "institution")]
    prints = [_listed(c) for f in ("record_fingerprints", "fingerprints", "records") for c in of(f)]
    prints += [x for c in of("support_details") for x in inside(c, "record_fingerprints", "fingerprints", "records")]
    out = rows.select(*flat, gathered(tx.squeeze, *told).alias("institutions"), gathered(tx.squeeze_ends, *prints).alias("record_fingerprints"), "source_file")
    out = out.select("*", F.coalesce("support.records", F.lit(0)).alias("records"), F.coalesce("support.count", F.lit(0)).alias("count"), F.monotonically_increasing_id().alias("ord"))
    return (out if level is None else out.where(F.col("level") == level)), bad


def decisions(spark: SparkSession, paths: str | list[str], level: int | None = None) -> tuple[DataFrame, DataFrame]:
    rows, bad = json_lines(spark, paths, schemas.DECISION)
    fields = [F.col(f"candidate.{f.name}").alias(f.name) for f in T._parse_datatype_string(schemas.CANDIDATE_FIELDS)]
    out = rows.select(*fields, "institutions", "record_fingerprints", "rationale", "weight", "passed")
    return (out if level is None else out.where(F.col("level") == level)), bad


def concepts(spark: SparkSession, paths: str | list[str], level: int | None = None, skip: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(concepts, quarantine) of one or more files; with ids to leave out."""
    rows, bad = json_lines(spark, paths, schemas.CONCEPT)
    if level is not None:
        rows = rows.where(F.col("level") == level)
    return (rows if skip is None else rows.join(skip.select("id"), "id", "left_anti")), bad


def contexts(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """concept_id, n, text, institution, url of lines with record or records."""
    record = f"struct<text:string,provenance:{schemas.PROVENANCE},meta:{schemas.META}>"
    rows, bad = json_lines(spark, paths, f"concept_id string, record {record}, records array<{record}>")
    each = rows.select("concept_id", F.posexplode(F.coalesce("records", F.array("record"))).alias("n", "r")).where("r is not null")
    return each.select("concept_id", "n", F.col("r.text").alias("text"), F.col("r.provenance.institution").alias("institution"), F.col("r.provenance.url").alias("url")), bad


def parents(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of candidates."""
    return spark.read.schema(schemas.CANDIDATE_FIELDS).option("multiLine", True).json(path)


def labelled(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation rows of a JSON list: source_text, gold_labels, institution, level under any of their usual names."""
    names = "source_text string, text string, input string, document string, gold_labels array<string>, expected array<string>, labels array<string>, institution string, campus string, organization string, level int, hierarchy_level int"
    rows = spark.read.schema(names).option("multiLine", True).json(path)
    return rows.select(F.coalesce("source_text", "text", "input", "document").alias("source_text"), F.coalesce("gold_labels", "expected", "labels").alias("gold_labels"), F.coalesce("institution", "campus", "organization").alias("institution"), F.coalesce("level", "hierarchy_level").alias("level"))


def sheets(spark: SparkSession, named_paths: dict[str, str]) -> DataFrame:
    """CSV exports of a workbook's sheets as one table: union by name, everything as text, with sheet_name."""
    out = None
    for name, path in named_paths.items():
        one = spark.read.option("header", True).csv(path).withColumn("sheet_name", F.lit(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def unprocessed(records: DataFrame, done: DataFrame, key: str = "record_id") -> DataFrame:
    """Records that an earlier, interrupted run has not finished: the resume step."""
    return records.join(done.select(key).distinct(), key, "left_anti")
