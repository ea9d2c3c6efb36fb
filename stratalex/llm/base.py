"""Shared pieces of the training-data operators.

Columns are always taken by position, so a table with further columns, even with names that clash with
an operator's own or with each other, is accepted: an output replaces input columns of its name.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

#: Rows and bytes of text that a Python operator turns into one output batch at most.
SLICE_ROWS, SLICE_BYTES = 512, 8 << 20


def position(df: DataFrame, name: str) -> int:
    """Place of a column: the first of exactly this name, else the first that differs in case only."""
    for same in (lambda c: c == name, lambda c: c.lower() == name.lower()):
        for i, c in enumerate(df.columns):
            if same(c):
                return i
    raise KeyError(f"no column {name} among {df.columns}")


def numbered(df: DataFrame) -> DataFrame:
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def pick(df: DataFrame, **new_to_old: str) -> DataFrame:
    """Only the named columns, renamed: pick(df, id="doc_id", text="text")."""
    at = {new: position(df, old) for new, old in new_to_old.items()}
    return numbered(df).select(*[F.col(f"c{i}").alias(new) for new, i in at.items()])


def others(df: DataFrame, taken: list[str]) -> list[int]:
    """Places of the columns that an output with the names `taken` leaves, each name once."""
    seen, out = {t.lower() for t in taken}, []
    for i, c in enumerate(df.columns):
        if c.lower() not in seen:
            seen.add(c.lower())
            out.append(i)
    return out


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of SLICE_BYTES in place of Spark's default of 64 MB, which both sides of each Python worker hold."""
    if spark.conf.get(BATCH_BYTES, "67108864b").rstrip("b") == str(64 << 20):
        spark.conf.set(BATCH_BYTES, str(SLICE_BYTES))


def with_columns(df: DataFrame, inputs: list[str], fn: Callable[..., list], outputs: pa.Schema, carry: list[str] | None = None) -> DataFrame:
    """Appends Python-made columns in one narrow pass: fn gets a list of values for each of `inputs`
    and returns a list of values for each field of `outputs`. `carry`: input columns to keep (None: all).
    Work goes on in slices, so memory follows SLICE_BYTES and the longest single text, not the partition."""
    bound_batches(df.sparkSession)
    at = [position(df, c) for c in inputs]
    keep = others(df, outputs.names) if carry is None else [position(df, c) for c in carry]
    need = sorted({*at, *keep})
    names = [df.columns[i] for i in keep]
    wide = numbered(df).select(*[f"c{i}" for i in need])
    schema = T.StructType([T.StructField(f"o{k}", df.schema.fields[i].dataType, True) for k, i in enumerate(keep)] + [T.StructField(f"p{k}", from_arrow_type(f.type), True) for k, f in enumerate(outputs)])
    read, kept, types = [need.index(i) for i in at], [need.index(i) for i in keep], list(outputs.types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                made = fn(*[part.column(i).to_pylist() for i in read])
                columns = [part.column(i) for i in kept] + [pa.array(v, type=t) for v, t in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=[f"o{k}" for k in range(len(kept))] + [f"p{k}" for k in range(len(types))])

    return wide.mapInArrow(run, schema).toDF(*names, *outputs.names)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    if batch.num_rows:
        each = max(1, batch.nbytes // batch.num_rows)
        step = max(1, min(SLICE_ROWS, SLICE_BYTES // each))
        for k in range(0, batch.num_rows, step):
            yield batch.slice(k, step)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session, set here only where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: lineage ends there and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z alone; a text of ASCII only takes the faster lower()."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))
