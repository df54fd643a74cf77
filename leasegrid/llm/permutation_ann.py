"""Approximate nearest neighbours by a permutation index.

Each vector is represented by the order of its nearest pivots and posted in the inverted files of its first few. A query probes
the files of as many of its own; each file ranks its vectors by the footrule distance between the two orders (sum of rank
differences over the query's nearest pivots), and those within a cut, `top` of them at least, are reranked by the exact inner
product in double precision. A vector met in several files counts in the query's first one only. Files are cut into blocks of
bounded size on both sides, however many vectors or queries have the same nearest pivots.

The number of pivots grows with the square root of the rows. How many files and which cut reach the share `aim` of true
neighbours is measured, not set: for `sample` queries the exact neighbours are found over all rows, and the least that
meets them is taken. So vectors with structure are searched in few small files, and vectors without any are scanned as widely
as they need. Pivots and these queries are the only sample: all rows are indexed.

A query that found fewer than `top` rows though there are more is searched again, exactly, against all rows in blocks. Vectors of
different length have no product: each length is indexed on its own, lengths with fewer than INDEXED rows are compared whole. Where
the sample's neighbours can't be met in the files that orders keep, a length is searched whole, too; the share met is logged.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, or have a null id, take no part; equal
scores are ordered by id; rows with the query's own id are no candidates; a query gets min(top, other ids of its length) rows; a
row that repeats an id is a candidate once, with its best vector, and takes one place in every cut; only the id and vector
columns are read.
"""

from __future__ import annotations

import logging
import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leasegrid.llm.embedding_dedup import sorted_tiles
from leasegrid.llm.shared import discard, written
from leasegrid.llm.vectors import by_length, matrix, mixed, pivots, spans, unit, usable

BLOCK, QUERIES = 16_384, 2_048
INDEXED = 64
LOG = logging.getLogger(__name__)
#: Longest part of an order that is kept, and how much of a query's the footrule reads.
KEPT, DEPTH = 64, 32
FOUND = "query_id long, length int, vec_id long, score double"


@dataclass(frozen=True)
class Index:
    """Of one vector length. Without pivots there is one file. blocks[file] = (blocks of queries, blocks of vectors)."""

    pivots: np.ndarray | None
    files: int
    cut: int
    blocks: np.ndarray

    def orders(self, x: np.ndarray) -> np.ndarray:
        """Numbers of the nearest pivots, nearest first (ties: smaller number)."""
        return np.argsort(-(unit(x) @ self.pivots.T).round(12), axis=1, kind="stable")[:, :KEPT].astype(np.uint16)


def _ranks(orders: np.ndarray, n: int) -> np.ndarray:
    """ranks[pivot, row]; pivots beyond the kept part of a row's order all have the rank after it."""
    ranks = np.full((len(orders), n), orders.shape[1], dtype=np.int16)
    np.put_along_axis(ranks, orders.astype(np.int64), np.arange(orders.shape[1], dtype=np.int16)[None, :], axis=1)
    return np.ascontiguousarray(ranks.T)


def _footrule(ranks: np.ndarray, own: list[int]) -> np.ndarray:
    foot = np.zeros(ranks.shape[1], dtype=np.int16)
    for at, name in enumerate(own[:DEPTH]):
        foot += np.abs(ranks[name] - np.int16(at))
    return foot


def _exact_neighbours(rows: DataFrame, queries: list, top: int) -> list:
    """(q, vec) of the `top` largest products of each of a few queries over all rows of their length."""
    length = len(queries[0]["vec"])
    shared = rows.sparkSession.sparkContext.broadcast((np.array([r["id"] for r in queries]), np.array([r["vec"] for r in queries], dtype=np.float64)))

    def run(batches):
        ids, q = shared.value
        held = [[] for _ in ids]
        for batch in batches:
            own, x = batch.column(0).to_numpy(), matrix(batch.column(1), length)
            value = np.where(own[None, :] == ids[:, None], -np.inf, q @ x.T)
            k = min(top, value.shape[1])
            best = np.argpartition(-value, k - 1, axis=1)[:, :k]
            for i, cols in enumerate(best):
                held[i] = sorted(held[i] + [(float(value[i, j]), x[j].tolist()) for j in cols if np.isfinite(value[i, j])], key=lambda r: -r[0])[:top]
        flat = [(i, s, v) for i, h in enumerate(held) for s, v in h]
        if flat:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*flat, strict=True), (pa.int32(), pa.float64(), pa.list_(pa.float64())), strict=True)], names=["q", "score", "vec"])

    best = rows.where(F.size("vec") == length).select("id", "vec").mapInArrow(run, "q int, score double, vec array<double>")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))
    return best.withColumn("r", place).where(F.col("r") <= top).select("q", "vec").collect()


def fit_index(rows: DataFrame, length: int, n: int, top: int, aim: float, sample: int) -> Index:
    """The index of one length; n rows have it."""
    p = pivots(rows, "id", "vec", min(1024, max(32, round(math.sqrt(n) / 4))), length)
    index = Index(p, 1, 0, np.ones((len(p), 2), dtype=np.int64))
    queries = rows.where(F.col("q") & (F.size("vec") == length)).orderBy(F.xxhash64("id", F.lit(9)), "id").limit(sample).select("id", F.col("vec").cast("array<double>").alias("vec")).collect()
    near = _exact_neighbours(rows, queries, top) if queries else []
    if not near:
        return index
    own = index.orders(np.array([r["vec"] for r in queries], dtype=np.float64))
    ranks = _ranks(index.orders(np.array([r["vec"] for r in near], dtype=np.float64)), len(p))
    q = np.array([r["q"] for r in near])
    ours = _ranks(own, len(p))[:, q]
    # Two rows meet in the first file that both are in.
    meet = np.maximum(ours, ranks).min(axis=0) + 1
    foot = np.concatenate([_footrule(ranks[:, i : i + 1], own[k].tolist()) for i, k in enumerate(q)])
    at = lambda values, share: int(np.sort(values)[min(len(values) - 1, math.ceil(share * len(values)) - 1)])
    files = min(at(meet, (1 + aim) / 2), own.shape[1])
    met = foot[meet <= files]
    fitted = replace(index, files=files, cut=at(met, min(1.0, aim * len(meet) / len(met)))) if len(met) else index
    share = float(((meet <= fitted.files) & (foot <= fitted.cut)).mean())
    LOG.info("length %d: %d of %d files and footrule %d meet %.3f of the sample's neighbours", length, fitted.files, len(p), fitted.cut, share)
    return fitted if share >= min(aim, 1.0) else Index(None, 1, 0, np.ones((1, 2), dtype=np.int64))


def _dealt(rows: DataFrame, indexes: dict[int, Index], count: bool) -> DataFrame:
    """With count: (length, file, queries, vectors). Else rows for (length, file, x, y), side 0 queries, 1 candidates.

    rows: id, q, vec; q marks queries.
    """
    shared = rows.sparkSession.sparkContext.broadcast(indexes)

    def run(batches):
        indexes = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                for length, part in by_length(batch.slice(at, 1024), 2):
                    if (index := indexes.get(length)) is None:
                        continue
                    query = np.flatnonzero(part.column(1).to_numpy(zero_copy_only=False))
                    if index.pivots is None:
                        order, files = None, np.zeros((part.num_rows, 1), np.int64)
                    else:
                        order = index.orders(matrix(part.column(2), length))
                        files = order[:, : index.files].astype(np.int64)
                    n = len(index.blocks)
                    if count:
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, length)), pa.array(np.arange(n)), pa.array(np.bincount(files[query].ravel(), minlength=n)), pa.array(np.bincount(files.ravel(), minlength=n))], names=["length", "file", "queries", "vectors"])
                        continue
                    mix, (nx, ny), each = mixed(part.column(0).to_numpy()), index.blocks.T, files.shape[1]
                    crow, cfile = np.repeat(np.arange(part.num_rows), each), files.ravel()
                    qrow, qfile = np.repeat(query, each), files[query].ravel()
                    c, cx = spans(nx[cfile])
                    q, qy = spans(ny[qfile])
                    place = np.stack([np.r_[cfile[c], qfile[q]], np.r_[cx, mix[qrow[q]] % nx[qfile[q]]], np.r_[mix[crow[c]] % ny[cfile[c]], qy], np.r_[np.ones(len(c), np.int64), np.zeros(len(q), np.int64)]])
                    row = np.r_[crow[c], qrow[q]]
                    kept = pa.array([o.tobytes() for o in order], pa.binary()) if order is not None else pa.nulls(part.num_rows, pa.binary())
                    for k in range(0, len(row), 8192):
                        take = pa.array(row[k : k + 8192])
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(take), length, np.int32)), *(pa.array(v[k : k + 8192].astype(np.int32)) for v in place), part.column(0).take(take), kept.take(take), part.column(2).take(take)], names=["length", "file", "x", "y", "side", "id", "kept", "vec"])

    kind = rows.schema["vec"].dataType.simpleString()
    return rows.mapInArrow(run, "length long, file long, queries long, vectors long" if count else f"length int, file int, x int, y int, side int, id long, kept binary, vec {kind}")


def _least_of_each(code: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The smallest value of each run of equal codes."""
    return np.minimum.reduceat(value, np.flatnonzero(np.r_[True, code[1:] != code[:-1]]))


def _search(table: pa.Table, indexes: dict[int, Index], top: int) -> pa.RecordBatch:
    """The best of one block of a file for each of its queries."""
    length, file = int(table.column("length")[0].as_py()), int(table.column("file")[0].as_py())
    index = indexes[length]
    side, ids = table.column("side").to_numpy(), table.column("id").to_numpy()
    x = matrix(table.column("vec").combine_chunks(), length)
    query, cand = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    cand = cand[np.argsort(ids[cand], kind="stable")]
    cid, cx = ids[cand], x[cand]
    # Cuts count ids, not rows; only where ids repeat do the two differ.
    each = _least_of_each if (cid[1:] == cid[:-1]).any() else lambda _, value: value
    if index.pivots is not None and len(query) and len(cand):
        orders = np.stack([np.frombuffer(o, np.uint16) for o in table.column("kept").to_pylist()])
        ranks = _ranks(orders[cand], len(index.pivots))
    qs, vs, scores = [], [], []
    for q in query if len(cand) else ():
        mine = cid != ids[q]
        if index.pivots is not None:
            own = orders[q].tolist()
            for before in own[: own.index(file)]:
                mine &= ranks[before] >= index.files
            mine = np.flatnonzero(mine)
            if len(mine):
                foot = _footrule(ranks, own)[mine]
                near = each(cid[mine], foot)
                k = min(top, len(near))
                mine = mine[foot <= max(index.cut, int(np.partition(near, k - 1)[k - 1]))]
        else:
            mine = np.flatnonzero(mine)
        if not len(mine):
            continue
        value = cx[mine] @ x[q]
        low = each(cid[mine], -value)
        if top < len(low):
            mine = mine[value >= -np.partition(low, top - 1)[top - 1] - 1e-9 * max(1.0, float(np.abs(value).max()))]
        # Element by element, so that equal vectors get equal scores wherever they lie.
        value = (cx[mine] * x[q]).sum(axis=1)
        best = np.lexsort((cid[mine], -value))
        best = best[np.sort(np.unique(cid[mine][best], return_index=True)[1])][:top]
        qs.append(np.full(len(best), ids[q]))
        vs.append(cid[mine][best])
        scores.append(value[best])
    join = lambda xs, kind: np.concatenate([*xs, np.zeros(0, kind)]).astype(kind)
    got = join(qs, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(got), pa.array(np.full(len(got), length, np.int32)), pa.array(join(vs, np.int64)), pa.array(join(scores, np.float64))], names=["query_id", "length", "vec_id", "score"])


def _found(rows: DataFrame, indexes: dict[int, Index], top: int) -> DataFrame:
    """Blocks are sized by what each file holds, then searched. A row a file comes back to the driver."""
    indexes = {k: replace(v, blocks=v.blocks.copy()) for k, v in indexes.items()}
    for r in _dealt(rows, indexes, True).groupBy("length", "file").agg(F.sum("queries").alias("q"), F.sum("vectors").alias("v")).collect():
        indexes[r["length"]].blocks[r["file"]] = max(1, -(-r["q"] // QUERIES)), max(1, -(-r["v"] // BLOCK))
    by = ["length", "file", "x", "y"]
    tiles = _dealt(rows, indexes, False).repartition(*by).sortWithinPartitions(*by)
    return tiles.mapInArrow(sorted_tiles(by, lambda t: _search(t, indexes, top)), FOUND)


def search(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", top: int = 20, aim: float = 0.96, sample: int = 96) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that is_query marks, its `top` largest inner products found.

    aim: share of true neighbours that the index is fitted to meet, measured on `sample` queries.
    """
    if top < 1 or not 0 < aim <= 1:
        raise ValueError("top must be 1 or more, aim over 0, 1 at most")
    every = vectors.select(F.col(id_col).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("q"), F.col(vec_col).alias("vec"))
    good = every.where(F.col("id").isNotNull() & usable("vec"))
    good = written(good.groupBy("id", "vec").agg(F.max("q").alias("q")).select("id", "q", "vec"), "vectors")
    # A row for each length that occurs.
    lengths = good.groupBy(F.size("vec").alias("length")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids")).collect()
    whole = Index(None, 1, 0, np.ones((1, 2), dtype=np.int64))
    indexes = {r["length"]: fit_index(good, r["length"], r["n"], top, aim, sample) if r["n"] >= INDEXED else whole for r in lengths}
    best = lambda df: df.groupBy("query_id", "length", "vec_id").agg(F.max("score").alias("score"))
    found = written(best(_found(good, indexes, top)), "found")
    want = vectors.sparkSession.createDataFrame([(r["length"], min(top, r["ids"] - 1)) for r in lengths], "length int, want long")
    have = found.groupBy("query_id", "length").agg(F.count(F.lit(1)).alias("have"))
    asked = good.where("q").select(F.col("id").alias("query_id"), F.size("vec").alias("length")).distinct()
    short = written(asked.join(F.broadcast(want), "length").join(have, ["query_id", "length"], "left").where(F.coalesce("have", F.lit(0)) < F.col("want")).select("query_id", "length"), "short")
    again = [r["length"] for r in short.select("length").distinct().collect()]
    if again:
        rows = good.withColumn("length", F.size("vec")).where(F.col("length").isin(again)).join(short.select(F.col("query_id").alias("id"), "length", F.lit(True).alias("s")), ["id", "length"], "left")
        rows = rows.select("id", (F.col("q") & F.col("s").isNotNull()).alias("q"), "vec")
        found = best(found.unionByName(_found(rows, {n: whole for n in again}, top)))
    else:
        discard(good, short)
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
