"""Command line: stages over files. python -m stratalex.cli STAGE --input PATH --output PATH [--set dotted.setting=JSON]"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import dedup, frequency, hierarchy, segment, validate, verify
from .plans.phases import remove_old
from .plans.runner import fixed
from .policies import flat, load
from .sources import readers, sinks


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="stratalex")
    parser.add_argument("stage", choices=["records", "frequency", "verify", "deduplicate", "validate", "assemble", "export", "config", "clean"])
    parser.add_argument("--input", action="append", default=[])
    parser.add_argument("--output")
    parser.add_argument("--snapshots", action="append", default=[])
    parser.add_argument("--level", type=int)
    parser.add_argument("--format", default="json")
    parser.add_argument("--limit", type=int, help="audit mode: so many rows of the input")
    parser.add_argument("--dry-run", action="store_true")
    parser.add_argument("--set", action="append", default=[], metavar="SETTING=JSON")
    given = parser.parse_args(args)
    if given.limit is not None and given.limit <= 0:
        parser.error("--limit must be positive")
    settings = {}
    for pair in given.set:
        name, _, raw = pair.partition("=")
        try:
            settings[name] = json.loads(raw)
        except ValueError:
            settings[name] = raw
    policies = load(settings)
    if given.stage == "config":
        print(json.dumps(flat(policies), indent=2, sort_keys=True, default=str))
        return 0
    spark = SparkSession.builder.appName(f"stratalex-{given.stage}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    return STAGES[given.stage](spark, given, policies)


def _capped(df, given, *order):
    return df.orderBy(*order).limit(given.limit) if given.limit else df


def _records(spark, given, p) -> int:
    pages, bad = readers.snapshots(spark, given.input)
    pages = _capped(pages.withColumn("page", F.col("canonical_url")), given, "page")
    out = segment.source_records(pages, p.extraction)
    sinks.json_lines(out, f"{given.output}/records", sort=["page", "ord"])
    sinks.quarantine(bad, f"{given.output}/quarantine")
    return 0


def _frequency(spark, given, p) -> int:
    rows, bad = readers.evidence(spark, given.input, given.level)
    decided = frequency.aggregate(_capped(rows, given, "ord"), p.frequency, p.institution)
    valid, broken = frequency.quarantine(decided)
    sinks.split_by_pass(valid, f"{given.output}/decisions")
    sinks.quarantine(bad, f"{given.output}/quarantine")
    sinks.document(spark, frequency.statistics(rows, valid).first().asDict() | {"quarantined": broken.count()}, f"{given.output}/metadata.json")
    return 0


def _verify(spark, given, p) -> int:
    rows, _ = readers.decisions(spark, given.input, given.level)
    decided = verify.decide(verify.evaluate(rows.drop("passed"), p.token, p.label), fixed('{"pass": true, "reason": "no model configured"}'), p.token)
    sinks.split_by_pass(decided, f"{given.output}/decisions")
    sinks.document(spark, verify.statistics(decided).first().asDict(), f"{given.output}/metadata.json")
    return 0


def _deduplicate(spark, given, p) -> int:
    rows, _ = readers.concepts(spark, given.input, given.level)
    rows = dedup.last_of_each(rows.withColumn("ord", F.xxhash64("source_file", "id"))).drop("source_file", "ord")
    pairs = dedup.scored(rows, p.dedup)
    links = dedup.edges(pairs)
    survivors, merges = dedup.merge(rows, links, p.dedup)
    sinks.dedup_result(survivors, merges, dedup.statistics(rows, pairs, links).first().asDict(), given.output)
    return 0


def _validate(spark, given, p) -> int:
    rows, _ = readers.concepts(spark, given.input, given.level)
    rows = rows.drop("source_file")
    judged = validate.rules(rows, p.validation)
    top = None
    if given.snapshots:
        pages, _ = readers.snapshots(spark, given.snapshots)
        found = validate.mentions(rows, pages.select(F.xxhash64("url").alias("snap"), "institution", F.col("canonical_url").alias("url"), "text"))
        top = validate.top_snippets(validate.snippets(rows, found, p.validation), p.validation)
        judged = validate.web(judged, top, policy=p.validation)
    decided = validate.vote(judged, p.validation)
    sinks.validation_result(validate.applied(decided), validate.rule_findings(judged), top if top is not None else rows.limit(0).select("id"), decided.agg(F.count("*").alias("checked"), F.count_if("decision.passed").alias("passed")).first().asDict(), given.output)
    return 0


def _assemble(spark, given, p) -> int:
    rows, _ = readers.concepts(spark, given.input)
    built = hierarchy.assemble(rows.drop("source_file"), p.hierarchy)
    told = hierarchy.report(built.nodes, built.edges, p.hierarchy)
    if not given.dry_run:
        sinks.graph(built.nodes, built.edges, f"{given.output}/graph", given.format)
        built.orphans.write.json(f"{given.output}/orphans")
        sinks.document(spark, told, f"{given.output}/report.json")
    return 0 if told["passed"] else 1


def _export(spark, given, p) -> int:
    rows, _ = readers.concepts(spark, given.input)
    sinks.export(rows.drop("source_file"), given.output, given.format, given.level)
    return 0


def _clean(spark, given, p) -> int:
    for path in remove_old(spark, given.input[0], dry_run=given.dry_run):
        print(path)
    return 0


STAGES = {"records": _records, "frequency": _frequency, "verify": _verify, "deduplicate": _deduplicate, "validate": _validate, "assemble": _assemble, "export": _export, "clean": _clean}

if __name__ == "__main__":
    sys.exit(main())
