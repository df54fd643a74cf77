"""Helpers that the operators of this subpackage share: durable intermediate tables and connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
import weakref

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Keys with more than one row in so many are hot; fewer than so many keys can be.
HOT = 500
_places: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir). Local sessions without one, as in tests, get a temporary one."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if place:
        return place.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not hasattr(shared_dir, "local"):
        shared_dir.local = "file://" + tempfile.mkdtemp(prefix="leasegrid-")
    return shared_dir.local


def scratch_dir(spark: SparkSession) -> str:
    """Where all intermediate tables of this application lie."""
    return f"{shared_dir(spark)}/leasegrid/{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write df once as a table in the shared folder and read it back: it is computed once and outlives executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _places[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of `written` that nothing reads any more; what an operator returns still reads its last ones."""
    for df in tables:
        if path := _places.pop(df, None):
            _delete(df.sparkSession, path)


def discard_all(spark: SparkSession) -> None:
    """Deletes every intermediate table of this application, once its results are stored."""
    _delete(spark, scratch_dir(spark))


def join_hot(left: DataFrame, right: DataFrame, key: str, rows: str, total: int, how: str = "inner") -> DataFrame:
    """left joined with right, which has one row a key and in `rows` how many rows of left, `total` in all, have it.

    Keys with more than total / HOT rows are fewer than HOT, so their side is broadcast and their rows stay where they are; all
    others are shuffled, none of them a hot one. `rows` is not part of the result.
    """
    least = total / HOT
    hot = right.where(F.col(rows) > least).drop(rows).withColumn("_hot", F.lit(True))
    marked = left.join(F.broadcast(hot), key, "left")
    names = [c for c in marked.columns if c != "_hot"]
    rest = marked.where("_hot is null").select(*left.columns).join(right.where(F.col(rows) <= least).drop(rows), key, how)
    return marked.where("_hot").select(*names).unionByName(rest.select(*names))


def connected(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star rounds.

    Returns (node, component) for every node with an edge to another node; component is the smallest node reachable.
    Minima are pre-aggregated before each shuffle and joined back by join_hot, so a hub's neighbours never meet in one task.
    Null ends and loops are ignored.
    """
    now = written(_stars(edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")), "edges")
    state = _state(now)
    for _ in range(max_rounds):
        if not state[0]:
            break
        half = written(_large(now, state[0]), "edges")
        discard(now)
        # At most as many edges as before.
        now = written(_small(half, state[0]), "edges")
        discard(half)
        before, state = state, _state(now)
        if before == state:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())


def _stars(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()


def _large(edges: DataFrame, n: int) -> DataFrame:
    """Every larger neighbour of u is linked to the smallest of u and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("rows")).select("u", F.least("u", "m").alias("m"), "rows")
    return _stars(join_hot(both.where("v > u"), low, "u", "rows", 2 * n).select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small(edges: DataFrame, n: int) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("rows"))
    return _stars(join_hot(edges, low, "u", "rows", n).select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def code_points(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code points of all words one after another, word of each, first of each word, end of each word).

    Words are told apart by their lengths, not by a separator, as a text may hold any character.
    """
    size = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    code = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    end = np.cumsum(size)
    return code, np.repeat(np.arange(len(size)), size), end - size, end


def data_file(name: str) -> str:
    """Where an installed tokenizer file lies; the package is a parameter of the environment, not of this library."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))


def slices(batch, column: int, max_bytes: int = 4 << 20, max_rows: int = 2048):
    """Consecutive parts of an Arrow batch whose texts have at most max_bytes together (a single longer text comes alone)."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto = np.concatenate([[0], np.cumsum(size)])
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(upto, upto[at] + max_bytes, side="right")) - 1
        end = min(max(end, at + 1), at + max_rows, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def carried(docs, names, made: tuple[str, ...]) -> str:
    """The schema text of columns of docs that an operator passes on; their names may not clash with what it makes."""
    if clash := set(names) & set(made):
        raise ValueError(f"can't carry {sorted(clash)}: the operator makes columns of that name")
    return "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
