"""Structured Streaming forms of the first stages, for documents that arrive as files. Beyond the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..functions import text as tx
from ..operators import segment
from ..policies import ExtractionPolicy, FrequencyPolicy


def snapshots(spark: SparkSession, folder: str, per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schemas.SNAPSHOT + ", language_confidence double").option("maxFilesPerTrigger", per_trigger).json(folder)


def fresh_pages(stream: DataFrame, delay: str = "14 days") -> DataFrame:
    """Pages whose text was not seen within the delay: the cache's checksum rule with bounded state."""
    return stream.withColumn("checksum", tx.checksum(F.coalesce("text", F.lit("")))).withWatermark("fetched_at", delay).dropDuplicatesWithinWatermark(["checksum"])


def records_to(stream: DataFrame, folder: str, checkpoint: str, policy: ExtractionPolicy = ExtractionPolicy()) -> StreamingQuery:
    """Source records of each micro-batch, in a folder by batch; a batch written again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        pages = batch.withColumn("page", F.coalesce("canonical_url", "url"))
        segment.source_records(pages, policy).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_support(stream: DataFrame, policy: FrequencyPolicy = FrequencyPolicy(), window: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Support of labels in windows of event time: level, key, institutions (approximate), n. stream: level, normalized,
    institution, seen_at."""
    keyed = stream.withWatermark("seen_at", delay)
    return keyed.groupBy(F.window("seen_at", window), "level", F.lower(tx.squeeze("normalized")).alias("key")).agg(F.approx_count_distinct("institution").alias("institutions"), F.count("*").alias("n"))
