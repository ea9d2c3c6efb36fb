"""The whole way from source records to a hierarchy, as phases of a pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup, extract, frequency, hierarchy, validate, verify
from ..policies import Policies
from .phases import Context, Pipeline, finish, fixed_point
from .runner import Runner


def level_phase(level: int, records: DataFrame, extractor: Runner, verifier: Runner):
    """Extraction, frequency filter, token verification and promotion of one level; parents come from the levels before."""

    def run(context: Context) -> DataFrame:
        p = context.policies
        above = None
        for k in range(level):
            one = context.tables[f"level_{k}"].select("id", "level", F.col("canonical_label").alias("label"), "aliases")
            above = one if above is None else above.unionByName(one)
        found, bad = extract.extract_level(records, level, extractor, above, p.label)
        context.run.counters.add("S1", "quarantined", bad.count())
        evidence = found.select("*", F.col("support.records").alias("records"), F.col("support.count").alias("count"), F.xxhash64("normalized", "parents").alias("ord"))
        decided = frequency.aggregate(evidence, p.frequency, p.institution)
        valid, _ = frequency.quarantine(decided.where("passed"))
        return verify.promote(verify.decide(verify.evaluate(valid, p.token, p.label), verifier, p.token))

    return run


def run_pipeline(spark: SparkSession, folder: str, records: DataFrame, extractor: Runner | list[Runner], verifier: Runner, snapshots: DataFrame | None = None, policies: Policies | None = None, resume: bool = False) -> tuple[Context, dict]:
    """Levels 0 to 3, consolidation, post-processing to a fixed point, assembly; gives the context and the manifest. The
    extractor is one runner, or one for each level."""
    policies = policies or Policies()
    context = Context(spark, folder, policies)

    def consolidate(c: Context) -> DataFrame:
        return extract.consolidate(*[c.tables[f"level_{k}"] for k in range(4)])

    def validated(concepts: DataFrame) -> DataFrame:
        judged = validate.rules(concepts, policies.validation)
        if snapshots is not None:
            top = validate.top_snippets(validate.snippets(concepts, validate.mentions(concepts, snapshots), policies.validation), policies.validation)
            judged = validate.web(judged, top, policy=policies.validation)
        return validate.applied(validate.vote(judged, policies.validation)).where("validation_passed").select(*concepts.columns)

    def deduplicated(concepts: DataFrame) -> DataFrame:
        links = dedup.edges(dedup.scored(concepts, policies.dedup))
        survivors, merges = dedup.merge(concepts, links, policies.dedup)
        return dedup.remap_parents(survivors, merges)

    def post(c: Context) -> DataFrame:
        out, rounds, converged = fixed_point(c.tables["consolidate"], [validated, deduplicated])
        c.notes["post_process"] = {"iterations": rounds, "converged": converged}
        return out

    def final(c: Context) -> DataFrame:
        built = hierarchy.assemble(c.tables["post_process"], policies.hierarchy)
        c.notes["hierarchy"] = hierarchy.report(built.nodes, built.edges, policies.hierarchy)
        c.notes["orphans"] = built.orphans.count()
        return built.nodes

    runners = extractor if isinstance(extractor, list) else [extractor] * 4
    levels = [(f"level_{k}", level_phase(k, records, runners[k], verifier)) for k in range(4)]
    Pipeline([*levels, ("consolidate", consolidate), ("post_process", post), ("finalize", final)]).execute(context, resume=resume)
    return context, finish(context)

