"""Sharding by size-tiered compaction, in DataFrame functions only.

A store is a folder of immutable Parquet shards under data/ and of manifests under manifest/. An arrival is appended
as small shards. Shards are tiered by size: tier t holds shards below BASE * FAN**(t+1) bytes. When a tier has FAN
shards or more, runs of similar size are merged into files of at most the target size (a shard that is larger stays as
it is). Reading a manifest reads its shards only, so a reader never sees half of a change.

A commit writes a new manifest beside the old ones and renames it to the next version, which fails if that version
exists: of two writers one wins and the other tries again on the newer version. A manifest holds the shards added and
removed by its commit; every FULL-th, and the one that vacuum() writes, holds all of them. Shards that no kept manifest names
are removed by vacuum(). The runs of a step are merged side by side, each by one task from its own inputs, without a shuffle,
and no task writes more than the target size. The driver holds an entry for each shard, never rows.

Defined cases: an arrival without rows commits a version without new shards; an empty store reads as no rows of its schema;
null values, equal rows and very long texts are stored as they are. Of columns whose names are equal or differ in case
only, the first is stored. Later arrivals may bring new columns, which read as null in earlier rows, and may lack
columns; a column that comes back with another type is refused with ValueError. Arrivals given together are committed in the
order of their values (numbers as numbers, nulls first). Shards are numbered by arrival and place in it, so that ties cannot occur.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import numbered, others

TARGET_BYTES, BASE_BYTES, FAN = 128 << 20, 1 << 20, 4
#: Runs merged by one commit at most, at once, and versions from one full manifest to the next.
MERGES, MERGES_AT_ONCE, FULL = 256, 16, 16
#: Shards whose names may be broadcast, some 150 bytes each.
BROADCAST_SHARDS = 1 << 17
ARRIVAL, NO_VALUE = "__arrival", "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True, order=True)
class Shard:
    arrival: int
    place: int
    path: str
    bytes: int


class ShardStore:
    def __init__(self, spark: SparkSession, folder: str, target: int = TARGET_BYTES, base: int = BASE_BYTES, fan: int = FAN):
        self.spark, self.folder, self.target, self.base, self.fan = spark, folder.rstrip("/"), target, base, fan
        self.jvm = spark._jvm
        self.fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def _files(self, folder: str) -> list[tuple[str, int]]:
        if not self.fs.exists(self._path(folder)):
            return []
        return sorted((f"{folder}/{s.getPath().getName()}", s.getLen()) for s in self.fs.listStatus(self._path(folder)))

    # manifests

    def versions(self) -> list[int]:
        names = [p.rpartition("/")[2] for p, _ in self._files(f"{self.folder}/manifest")]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def _stored(self, version: int) -> dict:
        stream = self.fs.open(self._path(f"{self.folder}/manifest/v{version:09d}.json"))
        try:
            return json.loads(bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
        finally:
            stream.close()

    def manifest(self, version: int | None = None) -> dict:
        """version, schema and shards (ordered) of a version, the latest if none is given."""
        version = version if version is not None else max(self.versions(), default=0)
        if not version:
            return {"version": 0, "schema": None, "shards": []}
        chain = [self._stored(version)]
        while not chain[-1]["full"]:
            chain.append(self._stored(chain[-1]["version"] - 1))
        shards: dict[str, Shard] = {}
        for change in reversed(chain):
            for path in change["removed"]:
                del shards[path]
            shards.update((s["path"], Shard(**s)) for s in change["added"])
        return {"version": version, "schema": chain[0]["schema"], "shards": sorted(shards.values())}

    def commit(self, change, full: bool = False) -> int:
        """change(manifest) gives (schema, shards). Retried on the newer version if another writer was first."""
        while True:
            now = self.manifest()
            schema, shards = change(now)
            version = now["version"] + 1
            whole = full or version % FULL == 1
            before = set() if whole else set(now["shards"])
            body = {"version": version, "schema": schema, "full": whole, "added": [asdict(s) for s in shards if s not in before], "removed": sorted(s.path for s in before.difference(shards))}
            fresh = self._path(f"{self.folder}/manifest/.{uuid.uuid4().hex}")
            out = self.fs.create(fresh, False)
            out.write(json.dumps(body).encode())
            out.close()
            options = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.spark._jsc.hadoopConfiguration())
            try:
                context.rename(fresh, self._path(f"{self.folder}/manifest/v{version:09d}.json"), options)
                return version
            except Exception as e:  # noqa: BLE001
                self.fs.delete(fresh, False)
                if "FileAlreadyExists" not in str(e):
                    raise

    # shards

    def _written(self, df: DataFrame) -> list[tuple[str, int]]:
        """Files with rows, in the order of the partitions that wrote them."""
        folder = f"{self.folder}/data/{uuid.uuid4().hex}"
        df.write.parquet(folder)
        files = [(p, n) for p, n in self._files(folder) if p.rpartition("/")[2].startswith("part-")]
        if len(files) == 1 and self.spark.read.schema(df.schema).parquet(files[0][0]).isEmpty():
            return []  # Spark writes one file for no rows
        return files

    def _add(self, schema: T.StructType, files: list[tuple[str, int]]) -> int:
        def change(m):
            number = m["version"] + 1
            return _widened(m["schema"], schema), [*m["shards"], *[Shard(number, k, p, n) for k, (p, n) in enumerate(files)]]

        return self.commit(change)

    def append(self, df: DataFrame) -> int:
        """Commits an arrival as small shards."""
        df = _once(df)
        _widened(self.manifest()["schema"], df.schema)  # a refusal comes before the rows are written
        return self._add(df.schema, self._written(df))

    def append_many(self, df: DataFrame, column: str) -> list[int]:
        """Writes arrivals, the values of a column that is not stored, in one job; commits each in the column's order, then compacts."""
        kind = df.schema[column].dataType
        df = df.withColumn(ARRIVAL, F.col(column)).drop(column)
        stored = _once(df.drop(ARRIVAL))
        _widened(self.manifest()["schema"], stored.schema)
        folder = f"{self.folder}/data/{uuid.uuid4().hex}"
        _once(df).write.partitionBy(ARRIVAL).parquet(folder)
        parts = {unquote(p.rpartition(f"{ARRIVAL}=")[2]): p for p, _ in self._files(folder) if p.rpartition("/")[2].startswith(f"{ARRIVAL}=")}
        number = float if isinstance(kind, T.NumericType) else str
        out = []
        for value in sorted(parts, key=lambda v: (v != NO_VALUE, number(v) if v != NO_VALUE else number(0), v)):
            out.append(self._add(stored.schema, [(p, n) for p, n in self._files(parts[value]) if p.rpartition("/")[2].startswith("part-")]))
        self.compact()
        return out

    def tier(self, size: int) -> int:
        t = 0
        while size >= self.base * self.fan ** (t + 1):
            t += 1
        return t

    def plan(self, shards: list[Shard]) -> list[list[Shard]]:
        """Runs to merge: tiers with FAN shards or more below the target size, packed in order up to the target."""
        tiers: dict[int, list[Shard]] = {}
        for s in shards:
            if s.bytes < self.target:
                tiers.setdefault(self.tier(s.bytes), []).append(s)
        runs = []
        for _, found in sorted(tiers.items()):
            if len(found) < self.fan:
                continue
            run, size = [], 0
            for s in sorted(found):
                if run and size + s.bytes > self.target:
                    runs.append(run)
                    run, size = [], 0
                run.append(s)
                size += s.bytes
            runs.append(run)
        return [r for r in runs if len(r) > 1]

    def compact(self) -> list[int]:
        """Merges until no tier is due; each step is one commit."""
        out = []
        while runs := self.plan(self.manifest()["shards"])[:MERGES]:
            schema = T.StructType.fromJson(json.loads(self.manifest()["schema"]))
            merge = lambda run, schema=schema: self._written(self.spark.read.schema(schema).parquet(*[s.path for s in run]).coalesce(1))
            with ThreadPoolExecutor(MERGES_AT_ONCE) as pool:  # a job a run, which leave each other's tasks room
                fresh = [Shard(max(run).arrival, max(run).place, p, n) for run, files in zip(runs, pool.map(merge, runs)) for p, n in files]
            gone = {s for run in runs for s in run}

            def change(m, gone=gone, fresh=fresh):
                if not gone <= set(m["shards"]):
                    raise RuntimeError("another writer has merged these shards")
                return m["schema"], [*[s for s in m["shards"] if s not in gone], *fresh]

            out.append(self.commit(change))
        return out

    def vacuum(self, keep: int = 1) -> int:
        """Commits a full manifest, then removes all versions but the last `keep` and the shards that none of those names."""
        self.commit(lambda m: (m["schema"], m["shards"]), full=True)
        versions = self.versions()
        named = {s.path for v in versions[-keep:] for s in self.manifest(v)["shards"]}
        gone = 0
        for folder, _ in self._files(f"{self.folder}/data"):
            for path, _ in self._files(folder):
                inner = self._files(path) if "=" in path.rpartition("/")[2] else [(path, 0)]
                for file, _ in inner:
                    if file not in named and file.rpartition("/")[2].startswith("part-"):
                        gone += self.fs.delete(self._path(file), False)
        last = versions[-keep:][0]
        while not self._stored(last)["full"]:
            last -= 1
        for v in versions:
            if v < last:
                self.fs.delete(self._path(f"{self.folder}/manifest/v{v:09d}.json"), False)
        return gone

    def read(self, version: int | None = None) -> DataFrame:
        found = self.manifest(version)
        schema = T.StructType.fromJson(json.loads(found["schema"])) if found["schema"] else T.StructType()
        if not found["shards"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[s.path for s in found["shards"]])

    def read_with_shards(self, version: int | None = None) -> DataFrame:
        """The rows with shard (its place in the manifest, from 0) and shard_bytes, in the place of stored columns of these names."""
        shards, rows = self.manifest(version)["shards"], self.read(version)
        kept = others(rows, ["shard", "shard_bytes"])
        names = [rows.columns[i] for i in kept]
        places = self.spark.createDataFrame([(s.path.rpartition("/data/")[2], k, s.bytes) for k, s in enumerate(shards)], "file string, shard long, shard_bytes long")
        file = F.regexp_extract(F.url_decode(rows.metadataColumn("_metadata")["file_path"]), "/data/([0-9a-f]{32}/.*)$", 1) if shards else F.lit("")
        wide = numbered(rows.select("*", file.alias("at"))).select(*[f"c{i}" for i in kept], f"c{len(rows.columns)}")
        places = F.broadcast(places) if len(shards) <= BROADCAST_SHARDS else places  # beyond, a join's largest key is one shard
        met = wide.join(places, F.col(f"c{len(rows.columns)}") == F.col("file"))
        return met.select(*[f"c{i}" for i in kept], "shard", "shard_bytes").toDF(*names, "shard", "shard_bytes")


def _once(df: DataFrame) -> DataFrame:
    """The first column of each name, whatever its case."""
    kept = others(df, [])
    return df if len(kept) == len(df.columns) else numbered(df).select(*[f"c{i}" for i in kept]).toDF(*[df.columns[i] for i in kept])


def _widened(schema: str | None, more: T.StructType) -> str:
    """The stored schema with the further columns of an arrival."""
    fields = T.StructType.fromJson(json.loads(schema)).fields if schema else []
    known = {f.name.lower(): f for f in fields}
    for f in more.fields:
        old = known.get(f.name.lower())
        if old is None:
            fields = [*fields, T.StructField(f.name, f.dataType, True)]
        elif old.dataType != f.dataType:
            raise ValueError(f"column {f.name} is {old.dataType.simpleString()} in the store and {f.dataType.simpleString()} in the arrival")
    return T.StructType(fields).json()
