"""Queries of the training-data operators: each applies one with its production parameters to its whole table."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, licences, ngrams, pii, quality, rules, shards, simhash, tokenstore
from .base import shared_folder, table
from .oracles import ORACLES  # noqa: F401

RANKS, TOKENIZER = "byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.json"
#: Arrivals into which op10 divides the documents.
ARRIVALS = 6


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    coded = bpe.round_trip(table(spark, sf_dir, "documents"), path, pattern, carry=["doc_id"])
    return coded.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.measure(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op3_tokenstore(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/token-ids-{uuid.uuid4().hex}"
    tokenstore.write(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(TOKENIZER))
    return tokenstore.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("token_ids").alias("ids_crc32"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents"), carry=["doc_id"])

    def joined(spans) -> F.Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in pii.BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents lie at source/lang/doc_id."""
    return licences.scan(table(spark, sf_dir, "documents"), path=F.concat_ws("/", "source", "lang", "doc_id"))


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    judged = rules.judge(documents, rules.fit(documents, table(spark, sf_dir, "labels")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ngrams.score(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "n_words", "n_backoff", F.round("log_score", 4).alias("log_score"), F.round("mean_log", 6).alias("mean_log"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scored = quality.score(documents, quality.fit(documents, table(spark, sf_dir, "labels")), carry=["doc_id"])
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents arrive in ARRIVALS parts by a hash of doc_id, are appended, compacted and read back with their shard."""
    store = shards.ShardStore(spark, f"{shared_folder(spark)}/shards-{uuid.uuid4().hex}")
    documents = table(spark, sf_dir, "documents")
    store.append_many(documents.withColumn("op10 arrival", F.pmod(F.xxhash64("doc_id"), F.lit(ARRIVALS))), "op10 arrival")
    store.vacuum()
    return store.read_with_shards().select("doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), "shard", "shard_bytes")


QUERIES = {f.__name__: f for f in (op1_bpe, op2_decontaminate, op3_tokenstore, op4_pii, op5_simhash, op6_licences, op7_rules, op8_ngrams, op9_quality, op10_shards)}
