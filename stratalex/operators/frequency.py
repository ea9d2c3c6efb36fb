"""Frequency filter: candidates are grouped across records and institutions and pass by support per level.

Input rows: level, label, normalized, parents, aliases, records, count, institutions, record_fingerprints and ord,
the place of the row (the first row of a group gives its label)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..policies import FrequencyPolicy, InstitutionPolicy

KEY = ["level", "key", "parent_key"]


def _empty() -> Column:
    return F.array().cast("array<string>")


def threshold(level: Column, policy: FrequencyPolicy, name: str) -> Column:
    out = None
    for k, t in enumerate(policy.thresholds):
        value = F.lit(getattr(t, name))
        out = F.when(level == k, value) if out is None else out.when(level == k, value)
    return out


def support_weight(institutions: Column, count: Column) -> Column:
    return 1.0 * institutions + 0.3 * F.log1p(count)


def keyed(evidence: DataFrame) -> DataFrame:
    parents = F.when(F.col("level") == 0, _empty()).otherwise(F.transform(F.coalesce("parents", _empty()), lambda p: F.lower(tx.squeeze(p))))
    return evidence.withColumn("key", F.lower(tx.squeeze("normalized"))).withColumn("parent_key", parents)


def aggregate(evidence: DataFrame, policy: FrequencyPolicy = FrequencyPolicy(), institutions: InstitutionPolicy | None = None) -> DataFrame:
    """A decision for each group: candidate fields, support, institutions, record_fingerprints, rationale, weight, passed.

    One pass over the input: a row becomes one for each of its institutions and fingerprints, the first of which carries its
    label and counts. These are aggregated by institution and near-duplicate key, where fingerprints collapse to the least,
    then by group; both aggregations combine before they shuffle."""
    rows = keyed(evidence)
    named = F.filter(F.coalesce("institutions", _empty()), lambda n: n != "")
    seen = F.when(F.size(named) > 0, F.transform(named, lambda n: tx.resolve_institution(n, institutions or InstitutionPolicy()))).otherwise(F.array(F.lit(policy.unknown_institution)))
    told = F.struct("ord", "label", F.trim("normalized").alias("normalized"))
    names = F.array_append(F.coalesce("aliases", _empty()), F.col("label"))
    each = rows.select(*KEY, told.alias("first"), names.alias("names"), F.greatest(F.col("count"), F.lit(0)).alias("n"), F.greatest(F.col("records"), F.lit(0)).alias("r"), F.coalesce("record_fingerprints", _empty()).alias("prints"), F.posexplode(F.array_distinct(seen)).alias("i", "institution"))
    each = each.select("*", F.posexplode_outer("prints").alias("j", "print"))
    lead = (F.col("i") == 0) & (F.coalesce("j", F.lit(0)) == 0)
    near = tx.near_duplicate_key(F.col("print"), policy.near_duplicate) if policy.near_duplicate.enabled else F.col("print")
    pairs = each.groupBy(*KEY, "institution", near.alias("near")).agg(
        F.min("print").alias("print"),
        F.min(F.when(lead, F.col("first"))).alias("first"),
        F.collect_set(F.when(lead, F.col("names"))).alias("names"),
        F.sum(F.when(lead, F.col("n"))).alias("n"),
        F.sum(F.when(lead, F.col("r"))).alias("r"),
    )
    groups = pairs.groupBy(*KEY).agg(
        F.min("first").alias("first"),
        F.array_sort(F.array_distinct(F.flatten(F.flatten(F.collect_list("names"))))).alias("aliases"),
        F.sum("n").alias("n_count"),
        F.sum("r").alias("n_records"),
        F.array_sort(F.collect_set("institution")).alias("institutions"),
        F.array_sort(F.collect_set("print")).alias("record_fingerprints"),
    )
    records = F.when(F.size("record_fingerprints") > 0, F.size("record_fingerprints").cast("long")).otherwise(F.col("n_records"))
    out = groups.select(
        "level",
        F.col("first.label").alias("label"),
        F.col("first.normalized").alias("normalized"),
        F.col("parent_key").alias("parents"),
        "aliases",
        F.struct(records.alias("records"), F.size("institutions").cast("long").alias("institutions"), F.col("n_count").cast("long").alias("count")).alias("support"),
        "institutions",
        "record_fingerprints",
    )
    return decide(out, policy)


def decide(grouped: DataFrame, policy: FrequencyPolicy = FrequencyPolicy()) -> DataFrame:
    """Adds rationale, weight and passed. An unknown level raises nothing and does not pass."""
    level, s = F.col("level"), F.col("support")
    places, least = threshold(level, policy, "min_institutions"), threshold(level, policy, "min_src_count")
    passed = F.coalesce((s["institutions"] >= places) & (s["records"] >= least), F.lit(False))
    weight = support_weight(s["institutions"], s["count"])
    reasons = F.array(
        F.format_string("institutions=%d (min %d), records=%d (min %d), count=%d, weight=%.2f", s["institutions"], places, s["records"], least, s["count"], weight),
        F.when(F.size("institutions") > 0, F.concat(F.lit("institutions_list="), F.array_join("institutions", ", "))).otherwise(F.lit("institutions_list=<unknown>")),
        F.concat(F.lit("weight_formula="), threshold(level, policy, "weight_formula")),
    )
    rationale = F.struct(F.create_map(F.lit("frequency"), passed).alias("passed_gates"), reasons.alias("reasons"), F.create_map(F.lit("min_institutions"), places.cast("double"), F.lit("min_src_count"), least.cast("double")).alias("thresholds"))
    return grouped.select("*", rationale.alias("rationale"), weight.alias("weight"), passed.alias("passed"))


def quarantine(decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid): a deeper candidate without parents must have exactly one institution."""
    bad = (F.col("level") > 0) & (F.size("parents") == 0) & (F.col("support.institutions") != 1)
    return decisions.where(~bad), decisions.where(bad).withColumn("reason", F.lit("missing-parents"))


def histogram(decisions: DataFrame) -> DataFrame:
    """level, institutions, groups: how many groups have so many institutions."""
    return decisions.groupBy("level", F.col("support.institutions").alias("institutions")).agg(F.count("*").alias("groups"))


def statistics(evidence: DataFrame, decisions: DataFrame) -> DataFrame:
    """One row: candidates_in, aggregated_groups, kept, dropped, institutions_unique (summed over groups)."""
    counts = decisions.agg(F.count("*").alias("aggregated_groups"), F.count_if("passed").alias("kept"), F.count_if(~F.col("passed")).alias("dropped"), F.coalesce(F.sum("support.institutions"), F.lit(0)).alias("institutions_unique"))
    return evidence.agg(F.count("*").alias("candidates_in")).crossJoin(counts)


def top_institutions(paths: DataFrame, most: int = 25) -> DataFrame:
    """Rows institution, department_path ('College -> Department'), sheet_name to a row for each institution: colleges,
    college_count, total_occurrences, sheets, primary_sheet; the `most` with most colleges."""
    rows = paths.select(F.trim("institution").alias("institution"), F.trim(F.element_at(F.split("department_path", "->"), 1)).alias("college"), F.coalesce("sheet_name", F.lit("<unspecified>")).alias("sheet")).where("college <> ''")
    each = rows.groupBy("institution", "college").agg(F.count("*").alias("n"), F.min("sheet").alias("sheet"))
    total = each.groupBy("institution").agg(F.array_sort(F.collect_set("college")).alias("colleges"), F.sum("n").alias("total_occurrences"), F.count("*").alias("college_count"), F.array_sort(F.collect_set("sheet")).alias("sheets"))
    return total.withColumn("primary_sheet", F.element_at("sheets", 1)).orderBy(F.desc("college_count"), F.desc("total_occurrences"), "institution").limit(most)
