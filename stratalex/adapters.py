"""The driver's tables in the roles of the stages' inputs. Every adapter is deterministic and SQL can express it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NONE = "array<string>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates with evidence: parts that nations' suppliers sold."""
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    p, s, n = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    rows = l.join(p, l.l_partkey == p.p_partkey).join(s, l.l_suppkey == s.s_suppkey).join(n, s.s_nationkey == n.n_nationkey)
    label = F.concat_ws(" ", "p_name", "p_brand", "p_size")
    level = (F.col("l_linenumber") % 4).cast("int")
    return rows.select(
        level.alias("level"),
        label.alias("label"),
        F.lower(label).alias("normalized"),
        F.when(level == 0, F.array().cast(NONE)).otherwise(F.array(F.lower("p_type"))).alias("parents"),
        F.array().cast(NONE).alias("aliases"),
        F.lit(1).cast("long").alias("records"),
        F.lit(1).cast("long").alias("count"),
        F.array("n_name").alias("institutions"),
        F.array(F.concat(F.lit("record:"), F.sha1(F.col("l_orderkey").cast("string").cast("binary")), F.lit("x"))).alias("record_fingerprints"),
        F.col("l_orderkey").alias("ord"),
    )


def versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations of orders' priorities, whose fingerprints are versions of a customer's record."""
    o, c, n = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    rows = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    none = F.array().cast(NONE)
    return rows.select(F.lit(3).alias("level"), F.col("o_orderpriority").alias("label"), F.lower("o_orderpriority").alias("normalized"), F.array(F.lower("c_mktsegment")).alias("parents"), none.alias("aliases"), F.lit(1).cast("long").alias("records"), F.lit(1).cast("long").alias("count"), F.array("n_name").alias("institutions"), F.array(F.concat(F.lit("record"), F.col("o_custkey").cast("string"), F.lit("x#v"), F.col("o_orderkey").cast("string"))).alias("record_fingerprints"), F.col("o_orderkey").alias("ord"))


def title(text: Column, words: int = 6) -> Column:
    return F.array_join(F.slice(F.split(F.trim(text), r"\s+"), 1, words), " ")


def concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concepts at level 2: the first six words of documents, under their language."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", title(F.col("text")).alias("t"))
    support = F.struct(F.lit(1).cast("long").alias("records"), (F.col("doc_id") % 5 + 1).cast("long").alias("institutions"), F.col("n_chars").cast("long").alias("count"))
    return d.select(F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("id"), F.lit(2).alias("level"), F.col("t").alias("canonical_label"), F.array("lang").alias("parents"), F.array().cast(NONE).alias("aliases"), support.alias("support"))


def part_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of one or several words at levels 0 to 3, with marks that rules forbid."""
    p = table(spark, sf_dir, "part")
    label = F.when(F.col("p_partkey") % 3 == 0, F.regexp_replace("p_name", " ", "-")).when(F.col("p_partkey") % 3 == 1, F.element_at(F.split("p_name", " "), 1)).otherwise(F.concat_ws(" ", "p_name", "p_type"))
    label = F.when(F.col("p_partkey") % 11 == 0, F.concat(F.lit("KDD "), F.col("p_size").cast("string"))).when(F.col("p_partkey") % 13 == 0, F.lit("Machine Learning")).when(F.col("p_partkey") % 17 == 0, F.concat(F.element_at(F.split("p_name", " "), 2), F.lit("_workshop"))).otherwise(label)
    return p.select("p_partkey", (F.col("p_partkey") % 4).cast("int").alias("level"), label.alias("label"), label.alias("normalized"), F.when(F.col("p_partkey") % 4 == 0, F.array().cast(NONE)).otherwise(F.array(F.lower("p_type"))).alias("parents"), F.array().cast(NONE).alias("aliases"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages: text with language and a confidence that varies."""
    d = table(spark, sf_dir, "documents")
    url = F.concat(F.lit("https://"), F.col("source"), F.when(F.col("doc_id") % 3 == 0, F.lit(".edu")).when(F.col("doc_id") % 3 == 1, F.lit(".acm.org")).otherwise(F.lit(".example.com")), F.lit("/d/"), F.col("doc_id").cast("string"))
    return d.select(F.col("doc_id").alias("page"), "text", "lang", (F.lit(0.7) + (F.col("doc_id") % 4) * 0.1).alias("language_confidence"), F.col("source").alias("institution"), url.alias("url"), url.alias("canonical_url"), F.lit("2025-01-01 00:00:00").cast("timestamp").alias("fetched_at"))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).select(F.col("page").alias("snap"), "institution", "url", "text")


def evidence_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concepts whose labels stand in documents: the first four words of benchmark items."""
    b = table(spark, sf_dir, "benchmark")
    return b.select(F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("id"), (F.col("item_id") % 4).cast("int").alias("level"), title(F.col("text"), 4).alias("canonical_label"), F.when(F.col("item_id") % 4 == 0, F.array().cast(NONE)).otherwise(F.array(F.lit("p"))).alias("parents"))


def hierarchy_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions, nations, suppliers and customers as four levels; some customers point to suppliers that do not exist."""
    def rows(df: DataFrame, level: int, id_: Column, label: Column, parents: Column) -> DataFrame:
        return df.select(id_.alias("id"), F.lit(level).alias("level"), label.alias("canonical_label"), parents.alias("parents"))

    def tag(mark: str, c: str | Column) -> Column:
        return F.concat(F.lit(mark), (F.col(c) if isinstance(c, str) else c).cast("string"))

    s = table(spark, sf_dir, "supplier")
    c = table(spark, sf_dir, "customer").crossJoin(s.agg(F.count("*").alias("n")))
    out = rows(table(spark, sf_dir, "region"), 0, tag("r", "r_regionkey"), F.col("r_name"), F.array().cast(NONE))
    out = out.unionByName(rows(table(spark, sf_dir, "nation"), 1, tag("n", "n_nationkey"), F.col("n_name"), F.array(tag("r", "n_regionkey"))))
    out = out.unionByName(rows(s, 2, tag("s", "s_suppkey"), F.col("s_name"), F.array(tag("n", "s_nationkey"))))
    lost = tag("s", F.col("c_custkey") % (F.col("n") + 10))
    two = F.array(lost, tag("s", (F.col("c_custkey") + 1) % F.col("n")))
    return out.unionByName(rows(c, 3, tag("c", "c_custkey"), F.col("c_name"), F.when(F.col("c_custkey") % 29 == 0, two).otherwise(F.array(lost))))


def senses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concepts that share labels: parts' names under their types and sizes."""
    p = table(spark, sf_dir, "part")
    each = p.groupBy("p_name", "p_type").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("p_brand")).alias("brands"))
    support = F.struct(F.col("n").alias("records"), F.size("brands").cast("long").alias("institutions"), (F.col("n") * 3).alias("count"))
    id_ = F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("@"), F.lower("p_type"))
    return each.select(id_.alias("id"), id_.alias("ord"), F.lit(2).alias("level"), F.initcap("p_name").alias("canonical_label"), F.array(F.lower("p_type"), F.lit("parts")).alias("parents"), F.array().cast(NONE).alias("aliases"), support.alias("support"), F.col("brands").alias("institutions"))


def talk(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Concepts and records of conversations: the label is the first word of the first turn, the records are the turns."""
    t = table(spark, sf_dir, "conversations")
    first = t.where("turn = 0").select(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("id"), F.lit(1).alias("level"), F.lower(F.element_at(F.split(F.trim("text"), r"\s+"), 1)).alias("canonical_label"), F.array("role").alias("parents"))
    return first, t.select(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("concept_id"), F.col("turn").alias("n"), "text", F.col("role").alias("institution"), F.lit(None).cast("string").alias("url"))
