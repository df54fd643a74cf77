"""Exact near-duplicate join of vectors by cosine, as a metric range join.

On unit vectors, cosine >= t is a distance of at most r = sqrt(2 - 2 t). Each vector's home is the cell of its nearest pivot. It
is copied to each other cell whose members can lie within r: by the triangle inequality those with d(x, p) <= d(x, home) + 2 r,
and, sharper, those whose dividing plane is within r of x. Every link of a vector is then found in its home cell, so cells join
independently and each counts the links of its own members only. Equal vectors are made one row first. Cells are cut into
tiles of bounded size; a tile gives link counts and a spanning forest, never its pairs. Vectors of different length have no
cosine: each length has pivots and cells of its own, eight cells at least, and the length is part of a cell's key.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link with nothing; a null id gets 0
links, a null component and kept = false; each row is a vector of its own, so rows that repeat an id with the same vector link
with each other, and rows that repeat it with another vector link only if the vectors do; component ids are the smallest id
reachable; only the id and vector columns are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leasegrid.llm.shared import connected, discard, join_hot, written
from leasegrid.llm.vectors import by_length, matrix, mixed, pivots, spans, unit, usable

HOMES, MEMBERS = 4096, 8192
#: The least number of cells; a length with fewer vectors is one cell.
CELLS = 8
SLACK = 1e-9
FAR = np.iinfo(np.int64).max


def _cells(u: np.ndarray, p: np.ndarray, apart: np.ndarray, radius: float):
    """(home of each row, matrix of the cells it must be in)."""
    square = np.maximum(2 - 2 * (u @ p.T), 0)
    home = square.argmin(axis=1)
    d, own = np.sqrt(square), square[np.arange(len(u)), home]
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = (square - own[:, None]) / (2 * apart[home])
    must = (d <= np.sqrt(own)[:, None] + 2 * radius + SLACK) & ~(plane > radius + SLACK)
    must[np.arange(len(u)), home] = True
    return home, must


def _dealt(vectors: DataFrame, cells: dict, radius: float, blocks: dict | None) -> DataFrame:
    """Without blocks: (length, cell, homes, members) counts. With: (length, cell, x, y, side, node, w, vec), side 0 for homes, 1 for members.

    cells: length -> (pivots, distances between them); a length that has none is one cell.
    """
    shared = vectors.sparkSession.sparkContext.broadcast((cells, blocks))

    def run(batches):
        cells, blocks = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                for length, part in by_length(batch.slice(at, 1024), 2):
                    if length in cells:
                        p, apart = cells[length]
                        home, must = _cells(unit(matrix(part.column(2), length)), p, apart, radius)
                    else:
                        home, must = np.zeros(part.num_rows, np.int64), np.ones((part.num_rows, 1), bool)
                    n = must.shape[1]
                    if blocks is None:
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, length)), pa.array(np.arange(n)), pa.array(np.bincount(home, minlength=n)), pa.array(must.sum(axis=0))], names=["length", "cell", "homes", "members"])
                        continue
                    mix = mixed(part.column(0).to_numpy())
                    nx, ny = blocks[length].T
                    own, y0 = spans(ny[home])
                    row, cell = np.nonzero(must)
                    pair, x1 = spans(nx[cell])
                    row, cell = row[pair], cell[pair]
                    place = np.stack([np.r_[home[own], cell], np.r_[mix[own] % nx[home[own]], x1], np.r_[y0, mix[row] % ny[cell]], np.r_[np.zeros(len(own), np.int64), np.ones(len(row), np.int64)]])
                    row = np.r_[own, row]
                    for k in range(0, len(row), 8192):
                        take = pa.array(row[k : k + 8192])
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(take), length, np.int32)), *(pa.array(c[k : k + 8192].astype(np.int32)) for c in place), *(part.column(c).take(take) for c in (0, 1, 2))], names=["length", "cell", "x", "y", "side", "node", "w", "vec"])

    kind = vectors.schema["vec"].dataType.simpleString()
    return vectors.mapInArrow(run, "length long, cell long, homes long, members long" if blocks is None else f"length int, cell int, x int, y int, side int, node long, w long, vec {kind}")


def _merge(found: np.ndarray, left: np.ndarray, right: np.ndarray, label: np.ndarray) -> None:
    """Joins left[i] with each right[j] that found[i, j] marks; label holds the smallest number of each component so far."""
    while True:
        low = np.minimum(label[left], np.where(found, label[right][None, :], FAR).min(axis=1))
        down = np.where(found, low[:, None], FAR).min(axis=0)
        up = np.arange(len(label))
        np.minimum.at(up, label[left], low)
        np.minimum.at(up, label[right], np.minimum(down, label[right]))
        while (up[up] != up).any():
            up = up[up]
        now = up[label]
        if (now == label).all():
            return
        label[:] = now


def _tile(table: pa.Table, least: float) -> pa.RecordBatch:
    """(a, b, n): a home's links in this tile with b null, and the forest's edges with n null."""
    side = table.column("side").to_numpy()
    nodes_of, w = table.column("node").to_numpy(), table.column("w").to_numpy()
    u = unit(matrix(table.column("vec").combine_chunks(), int(table.column("length")[0].as_py())))
    homes, members = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    nodes, number = np.unique(nodes_of, return_inverse=True)
    label, links = np.arange(len(nodes)), np.zeros(len(homes), dtype=np.int64)
    for at in range(0, len(homes), 256):
        own = homes[at : at + 256]
        found = (u[own] @ u[members].T) >= least
        found &= number[own][:, None] != number[members][None, :]
        links[at : at + 256] = found @ w[members]
        rows, columns = np.flatnonzero(found.any(axis=1)), np.flatnonzero(found.any(axis=0))
        if len(rows):
            _merge(found[np.ix_(rows, columns)], number[own[rows]], number[members[columns]], label)
    tied = np.flatnonzero(label != np.arange(len(nodes)))
    has = links > 0
    a = np.concatenate([nodes_of[homes][has], nodes[tied]])
    none = np.concatenate([np.zeros(has.sum(), bool), np.ones(len(tied), bool)])
    b = np.concatenate([np.zeros(has.sum(), np.int64), nodes[label[tied]]])
    n = np.concatenate([links[has], np.zeros(len(tied), np.int64)])
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b, mask=~none), pa.array(n, mask=none)], names=["a", "b", "n"])


def sorted_tiles(keys: list[str], work):
    """A function for mapInArrow over partitions sorted by keys: work(table) for each tile, one at a time."""

    def run(batches):
        held = []
        now = None
        for batch in batches:
            key = np.stack([batch.column(k).to_numpy() for k in keys])
            cut = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for i, j in zip(cut[:-1], cut[1:], strict=True):
                if i == j:
                    continue
                if (own := tuple(key[:, i].tolist())) != now and held:
                    yield work(pa.Table.from_batches(held))
                    held = []
                now = own
                held.append(batch.slice(i, j - i))
        if held:
            yield work(pa.Table.from_batches(held))

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", least: float = 0.9, cell_rows: int = 4096, most_pivots: int = 2048) -> DataFrame:
    """(id_col, n_links, component_id, kept) for each row."""
    if not 0 < least <= 1:
        raise ValueError("least must be over 0, 1 at most")
    every = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    takes_part = F.col("id").isNotNull() & usable("vec")
    key = F.struct(F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2"))
    good = every.where(takes_part).withColumn("key", key)
    # Every distinct vector once, with a number that stays as it is, because the table is written.
    reps = good.groupBy("key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("w"), F.first("vec").alias("vec"))
    reps = written(reps.withColumn("node", F.monotonically_increasing_id()), "vectors")
    vecs, radius = reps.select("node", "w", "vec"), math.sqrt(2 - 2 * least)
    # A row for each length that occurs.
    lengths = reps.groupBy(F.size("vec").alias("length")).agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w")).collect()
    cells = {}
    for r in lengths:
        if r["n"] >= CELLS:
            p = pivots(vecs, "node", "vec", min(most_pivots, max(CELLS, -(-r["n"] // cell_rows))), r["length"])
            cells[r["length"]] = p, np.sqrt(np.maximum(2 - 2 * (p @ p.T), 0))
    # A row for each pivot comes back.
    blocks = {r["length"]: np.ones((len(cells[r["length"]][0]) if r["length"] in cells else 1, 2), dtype=np.int64) for r in lengths}
    for r in _dealt(vecs, cells, radius, None).groupBy("length", "cell").agg(F.sum("homes").alias("homes"), F.sum("members").alias("members")).collect():
        blocks[r["length"]][r["cell"]] = max(1, -(-r["homes"] // HOMES)), max(1, -(-r["members"] // MEMBERS))
    by = ["length", "cell", "x", "y"]
    tiles = _dealt(vecs, cells, radius, blocks).repartition(*by).sortWithinPartitions(*by)
    found = written(tiles.mapInArrow(sorted_tiles(by, lambda t: _tile(t, least)), "a long, b long, n long"), "vector-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    groups = connected(found.where("b is not null").select("a", "b"))
    own = written(reps.select("key", "id", "w", "node").join(counts, "node", "left").join(groups, "node", "left").select("key", "id", "w", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "node").alias("component")), "vector-groups")
    discard(reps, found)
    low = own.groupBy("component").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("rows"))
    total = sum(r["n"] for r in lengths)
    own = join_hot(own, low, "component", "rows", total).select("key", (F.col("n") + F.col("w") - 1).alias("n_links"), F.col("low").alias("component_id"), F.col("w").alias("rows"))
    linked = join_hot(good.select("id", "key"), own, "key", "rows", sum(r["w"] for r in lengths))
    alone = every.where(~takes_part).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.select("id", "n_links", "component_id").unionByName(alone).withColumnRenamed("id", id_col)
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
