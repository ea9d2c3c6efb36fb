"""Training-data pipeline: STAGES are (name, function); each function takes (spark, docs, sf_dir) and returns a table.

Defined cases: a null text counts as empty in every stage (its score is that of an empty text; null, empty and wordless texts
are near copies of each other; it has no leak, no personal data and no ids); null ids are kept as rows; of equal rows one stays;
ties go to the least doc_id, then the least hash of the text; very long texts are read whole; an empty table stays empty;
further columns, also with clashing names, pass through all stages but the last, which returns its own columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalex.llm import bpe, decontaminate, pii, quality, shingles
from stratalex.llm.base import cut, table

#: Documents that score less are rejected.
LEAST_QUALITY = 0.3
RANKS = "byte_bpe_multi_50k.tiktoken"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), model, text=f"c{_place(docs, 'text')}")
    return scored.where(F.col("score") >= LEAST_QUALITY).drop("score").toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by Jaccard similarity of at least 0.8 of five-word shingles; candidates by the trees of
    SimHash fingerprints, and by MinHash and a prefix join what these miss."""
    return shingles.drop_similar(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark window."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts <KIND> in the place of personal data; n_chars follows."""
    return pii.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, token_ids (little-endian unsigned 32-bit), n_tokens and round_trip (the ids decode to the text)."""
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    coded = bpe.round_trip(docs, path, pattern, carry=["doc_id", "lang", "source", "text"])
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", "token_ids", "n_tokens", same.alias("round_trip"))


def _place(df: DataFrame, name: str) -> int:
    return [c.lower() for c in df.columns].index(name)


STAGES = [("quality", keep_quality), ("near_copies", drop_near_copies), ("benchmark_leaks", drop_leaks), ("personal_data", redact_personal), ("token_ids", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The stages hold a learned classifier and a token coder, which SQL does not express.
ORACLE_SQL = None
