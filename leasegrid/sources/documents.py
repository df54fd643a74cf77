"""Versioned documents: every save is an audit copy that stays, and commits are manifests put in place by one rename.

A save writes only the documents it is given. The manifest of a version names all folders that count; it is written aside and renamed,
and the rename fails if another writer was first. A manifest that can't be read is moved aside, and the one before it counts.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leasegrid.sources.files import names


class Conflict(RuntimeError):
    """Another writer committed first."""


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def write_text(spark: SparkSession, path: str, text: str, replace: bool = True) -> None:
    """The whole text or nothing: written aside and renamed. Without replace an existing file raises Conflict."""
    jvm, fs, at = _fs(spark, path)
    aside = jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}.{uuid.uuid4().hex}")
    file = fs.create(aside)
    try:
        file.write(bytearray(text, "utf-8"))
    finally:
        file.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE if replace else rename.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration()).rename(aside, at, how)
    except Exception as e:
        fs.delete(aside, False)
        if "FileAlreadyExistsException" in str(e):
            raise Conflict(path) from e
        raise


def read_object(spark: SparkSession, path: str) -> dict | None:
    """The JSON object in a file; None if there is no file, or if it holds none, which is then moved aside to <name>.corrupt.<n>."""
    jvm, fs, at = _fs(spark, path)
    if not fs.exists(at):
        return None
    file = fs.open(at)
    try:
        found = json.loads(bytes(file.readAllBytes()).decode("utf-8"))
        if isinstance(found, dict):
            return found
    except ValueError:
        pass
    finally:
        file.close()
    taken = [n for n in names(spark, at.getParent().toString()) if n.startswith(f"{at.getName()}.corrupt.")]
    fs.rename(at, jvm.org.apache.hadoop.fs.Path(at.getParent(), f"{at.getName()}.corrupt.{len(taken)}"))
    return None


class DocumentStore:
    """Documents of one schema below root, each with a key; the columns version and saved are the store's."""

    def __init__(self, spark: SparkSession, root: str, key: str):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key

    def _manifest(self) -> tuple[int, list[str]]:
        """Number and folders of the last version that can be read; a version that can't keeps its number."""
        at = f"{self.root}/manifest"
        numbers = sorted((int(n[1:]) for n in names(self.spark, at) if n[:1] == "v" and n[1:].isdigit()), reverse=True)
        spent = max((int(n[1:].split(".")[0]) for n in names(self.spark, at) if n[:1] == "v" and ".corrupt." in n), default=0)
        for n in numbers:
            found = read_object(self.spark, f"{at}/v{n:08d}")
            if found is not None:
                return max(n, spent), found["saves"]
            spent = max(spent, n)
        return spent, []

    def audit(self) -> DataFrame | None:
        """Every copy ever saved; None before the first save."""
        saves = self._manifest()[1]
        return self.spark.read.parquet(*[f"{self.root}/data/{s}" for s in saves]) if saves else None

    def current(self) -> DataFrame | None:
        """The last version of each document."""
        every = self.audit()
        if every is None:
            return None
        own = [c for c in every.columns if c != self.key]
        return every.groupBy(self.key).agg(F.max(F.struct("version", *[c for c in own if c != "version"])).alias("_last")).select(self.key, *[F.col(f"_last.{c}").alias(c) for c in own])

    def begin(self) -> tuple[int, list[str]]:
        """What a save builds on; given to save, that save fails if another one came in between."""
        return self._manifest()

    def save(self, docs: DataFrame, base: tuple[int, list[str]] | None = None) -> int:
        """Saves docs, a row a document, as the next version of each; returns the number of the commit. Rows without key raise nothing and go.

        Of rows that repeat a key each is a version of its own, in order of their other columns.
        """
        number, saves = base or self._manifest()
        docs = docs.where(F.col(self.key).isNotNull())
        turn = F.row_number().over(Window.partitionBy(self.key).orderBy(*[c for c in docs.columns if c != self.key]))
        new = docs.withColumn("version", turn.cast("long"))
        if saves:
            before = self.spark.read.parquet(*[f"{self.root}/data/{s}" for s in saves]).groupBy(self.key).agg(F.max("version").alias("_before"))
            new = new.join(before, self.key, "left").withColumn("version", F.col("version") + F.coalesce("_before", F.lit(0))).drop("_before")
        name = f"save={number + 1:08d}-{uuid.uuid4().hex}"
        new.withColumn("saved", F.lit(number + 1).cast("long")).write.parquet(f"{self.root}/data/{name}")
        write_text(self.spark, f"{self.root}/manifest/v{number + 1:08d}", json.dumps({"saves": [*saves, name]}), replace=False)
        return number + 1
