"""Size-tiered compaction of immutable shards under a versioned manifest. DataFrame operations only.

Arrivals are appended as they come, one small run each, without a shuffle; one append is one version, however many runs it makes.
A run's tier is the logarithm of its size to the base `fan`. Once a tier has `fan` runs, they are merged into one run of
target-sized files. Each change is a new manifest version, written aside and put in place by one rename that fails if the version
exists; readers of older versions are not disturbed, and a writer that dies or comes second leaves only files that no manifest
names. That rename is atomic on HDFS and local disks; object stores that copy instead need a committer of their own.

A manifest has for each run its files with their sizes, its rows and its schema, so that a partial loss shows (`lost`).

Defined results: every row of every arrival is in exactly one live shard; null arrivals are one arrival, which is not that of the
text "null"; an empty table makes no run; rows may repeat; texts may be empty or of any length; columns may have any name, as
what `read` says about a row stands beside it in columns of its own, the row being a struct. Runs may have unlike columns: a row has
all columns of the version, null where its arrival had none, before compaction and after it. An arrival that gives a column (whatever
the case of its name) another type than live runs do is refused before anything is written.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType


@dataclass(frozen=True)
class Run:
    number: int
    tier: int
    bytes: int
    rows: int
    path: str
    schema: str
    files: tuple[tuple[str, int], ...]


def _schema(run: Run) -> StructType:
    return StructType.fromJson(json.loads(run.schema))


def merged_schema(schemas: Iterable[StructType]) -> StructType:
    """All columns of the schemas, nullable, in order of first sight; one of two types raises."""
    found: dict[str, StructField] = {}
    for schema in schemas:
        for f in schema:
            kind = _nullable(f.dataType)
            if (have := found.setdefault(f.name.lower(), StructField(f.name, kind))).dataType != kind:
                raise ValueError(f"column {f.name} is {kind.simpleString()}, but {have.dataType.simpleString()} in what is stored")
    return StructType(list(found.values()))


def _nullable(kind: DataType) -> DataType:
    """The type with nulls allowed at any depth, so that types compare by what they hold."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _nullable(f.dataType)) for f in kind])
    if isinstance(kind, ArrayType):
        return ArrayType(_nullable(kind.elementType))
    if isinstance(kind, MapType):
        return MapType(_nullable(kind.keyType), _nullable(kind.valueType))
    return kind


class ShardStore:
    """Shards below one root that the driver and the executors share."""

    def __init__(self, spark: SparkSession, root: str, target_bytes: int = 128 << 20, base_bytes: int = 1 << 20, fan: int = 4):
        if fan < 2 or target_bytes < 1 or base_bytes < 1:
            raise ValueError("fan must be 2 or more, sizes 1 or more")
        self.spark, self.root = spark, root.rstrip("/")
        self.target, self.base, self.fan = target_bytes, base_bytes, fan

    # Files, by Hadoop's interface: the same on any store that Spark writes to.
    def _fs(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return jvm, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _files(self, path: str) -> tuple[tuple[str, int], ...]:
        """(name, bytes) of the files of a run that are there."""
        jvm, fs = self._fs()
        at = jvm.org.apache.hadoop.fs.Path(path)
        return tuple(sorted((s.getPath().getName(), s.getLen()) for s in fs.listStatus(at) if s.getPath().getName().startswith("part-"))) if fs.exists(at) else ()

    def _run(self, number: int, path: str, rows: int, schema: StructType) -> Run:
        files = self._files(path)
        size = sum(n for _, n in files)
        return Run(number, self.tier(size), size, rows, path, schema.json(), files)

    def versions(self) -> list[int]:
        jvm, fs = self._fs()
        place = jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifest")
        return sorted(int(s.getPath().getName()[1:]) for s in fs.listStatus(place) if s.getPath().getName().startswith("v")) if fs.exists(place) else []

    def runs(self, version: int | None = None) -> list[Run]:
        """The live runs of a version, the latest by default. A manifest has a line a run."""
        have = self.versions()
        if not have:
            return []
        version = have[-1] if version is None else version
        jvm, fs = self._fs()
        file = fs.open(jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifest/v{version:08d}"))
        try:
            lines = bytes(file.readAllBytes()).decode().splitlines()
        finally:
            file.close()
        found = [json.loads(x) for x in lines]
        return sorted((Run(**{**x, "files": tuple((n, size) for n, size in x["files"])}) for x in found), key=lambda r: r.number)

    def lost(self, version: int | None = None) -> list[str]:
        """Files that a version names and that are gone or of another size."""
        return [f"{r.path}/{name}" for r in self.runs(version) for there in [dict(self._files(r.path))] for name, size in r.files if there.get(name) != size]

    def commit(self, runs: list[Run], version: int) -> None:
        """Puts a version in place; raises if another writer was first."""
        aside = f"{self.root}/manifest/.aside-{uuid.uuid4().hex}"
        jvm, fs = self._fs()
        at = jvm.org.apache.hadoop.fs.Path
        file = fs.create(at(aside))
        try:
            file.write(bytearray("".join(json.dumps(asdict(r), sort_keys=True) + "\n" for r in runs), "utf-8"))
        finally:
            file.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(at(self.root).toUri(), self.spark._jsc.hadoopConfiguration())
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.NONE
        files.rename(at(aside), at(f"{self.root}/manifest/v{version:08d}"), how)

    def tier(self, size: int) -> int:
        return max(0, math.floor(math.log(max(size, 1) / self.base, self.fan) + 1e-12)) if size > self.base else 0

    def append(self, df: DataFrame, arrival: Column | None = None) -> None:
        """Appends df as one run, or one for each value of `arrival`, in one pass over it and as one version."""
        live, have = self.runs(), self.versions()
        merged_schema([*map(_schema, live), df.schema])
        place = f"{self.root}/data/{uuid.uuid4().hex}"
        key = F.lit("all") if arrival is None else F.coalesce(F.sha2(arrival.cast("string"), 256), F.lit("null"))
        name = "arrival"
        while name.lower() in (c.lower() for c in df.columns):
            name += "_"
        df.withColumn(name, key).write.partitionBy(name).parquet(place)
        jvm, fs = self._fs()
        found = sorted(s.getPath().toString() for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(place)) if s.isDirectory())
        if not found:
            return
        first = max((r.number for r in live), default=-1) + 1
        # One job for all arrivals, over the footers of their files.
        rows = dict(self.spark.read.schema(f"`{name}` string").parquet(place).groupBy(name).count().collect())
        made = [self._run(first + i, path, rows[path.rpartition("=")[2]], df.schema) for i, path in enumerate(found)]
        self.commit([*live, *made], (have[-1] if have else 0) + 1)

    def compact(self) -> int:
        """Merges while a tier has `fan` runs; returns the number of merges."""
        merges = 0
        while True:
            live, have = self.runs(), self.versions()
            by: dict[int, list[Run]] = {}
            for r in live:
                by.setdefault(r.tier, []).append(r)
            full = [runs[: self.fan] for _, runs in sorted(by.items()) if len(runs) >= self.fan]
            if not full:
                return merges
            old = full[0]
            place = f"{self.root}/data/{uuid.uuid4().hex}"
            files = max(1, math.ceil(sum(r.bytes for r in old) / self.target))
            schema = merged_schema(map(_schema, old))
            self.spark.read.schema(schema).parquet(*[r.path for r in old]).coalesce(files).write.parquet(place)
            # Its tier is that of its size, so equal tiers are of similar size; each merge leaves fewer runs, so this ends.
            made = self._run(max(r.number for r in live) + 1, place, sum(r.rows for r in old), schema)
            self.commit([r for r in live if r not in old] + [made], have[-1] + 1)
            merges += 1

    def read(self, version: int | None = None) -> DataFrame | None:
        """(row, run, tier, shard) of each row of a version; shard is the number of the file in its run. None if there are no runs."""
        runs = self.runs(version)
        schema = merged_schema(map(_schema, runs))
        parts = [
            self.spark.read.schema(schema).parquet(r.path).select(F.struct("*").alias("row"), F.lit(r.number).alias("run"), F.lit(r.tier).alias("tier"), F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int").alias("shard"))
            for r in runs
        ]
        out = None
        for part in parts:
            out = part if out is None else out.union(part)
        return out

    def vacuum(self, keep_versions: int = 1) -> int:
        """Deletes versions but the last ones and the runs that only those name; returns how many runs went."""
        jvm, fs = self._fs()
        have = self.versions()
        live = {r.path for v in have[-keep_versions:] for r in self.runs(v)}
        gone = {r.path for v in have[:-keep_versions] for r in self.runs(v)} - live
        for v in have[:-keep_versions]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifest/v{v:08d}"), True)
        for path in gone:
            fs.delete(jvm.org.apache.hadoop.fs.Path(path), True)
        return len(gone)
