"""Conflict-constrained best-fit packing of documents into bins of one capacity.

Documents longer than a bin are cut, at limits of characters, into pieces that fill a bin each and a rest. Rests are dealt evenly to
shards of a bounded number of pieces; each shard packs on its own, largest first. Its open bins are kept in order of free space,
and each bin carries two bitmaps: the source slots and the duplicate clusters that it holds. The successor search starts at the
smallest free space that is enough and goes on until a bin shares no bit with the piece; that is the tightest compatible bin.

A source has `slots` slots, given to its documents by hash, so a bin holds at most that many documents of a source; members
of one duplicate cluster (texts equal after lower-casing and trimming) never share a bin.

Sizes are UTF-8 bytes: a tokenizer's counts cost many times the packing, and a bin of 4 bytes a token is close enough to fill.

Defined results: null and empty texts are one piece of size 0 in no bin (bin and at are null); a text that its full pieces hold has no
rest; a null source is a source; rows may repeat, each is packed; the bins depend on the rows only, not on how files or
partitions hold them; only the named columns are read.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PACKED = "piece int, start long, size long, shard int, bin int, at long"
#: Copies of one row that a task deals out at most.
COPIES = 4096


def best_fit(pieces: list[tuple[int, str, int | None]], capacity: int, slot_bits: dict | None = None) -> list[tuple[int, int]]:
    """(bin, offset) of each (size, source slot, cluster), packed largest first; of equals the earlier piece comes first."""
    slots: dict = {} if slot_bits is None else slot_bits
    clusters: dict = {}
    free: list[tuple[int, int]] = []
    held: list[list[int]] = []
    out = [(0, 0)] * len(pieces)
    for i in sorted(range(len(pieces)), key=lambda i: (-pieces[i][0], i)):
        size, slot, cluster = pieces[i]
        source_bit = 1 << slots.setdefault(slot, len(slots))
        cluster_bit = 0 if cluster is None else 1 << clusters.setdefault(cluster, len(clusters))
        k = bisect_left(free, (size, -1))
        while k < len(free) and (held[free[k][1]][0] & source_bit or held[free[k][1]][1] & cluster_bit):
            k += 1
        if k < len(free):
            room, b = free.pop(k)
            out[i] = (b, capacity - room)
            insort(free, (room - size, b))
            held[b][0] |= source_bit
            held[b][1] |= cluster_bit
        else:
            out[i] = (len(held), 0)
            insort(free, (capacity - size, len(held)))
            held.append([source_bit, cluster_bit])
    return out


def cuts(text: bytes, capacity: int) -> list[int]:
    """Where the pieces of a text start; none is longer than capacity and none starts within a character."""
    starts = [0]
    while len(text) - starts[-1] > capacity:
        at = starts[-1] + capacity
        while text[at] & 0xC0 == 0x80:
            at -= 1
        starts.append(at)
    return starts


def _measured(capacity: int):
    """(id, source, cluster, size, starts) of (id, source, cluster, text); starts is null for texts of one piece."""

    def run(batches):
        for batch in batches:
            text = batch.column(3)
            size = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
            starts = [None] * batch.num_rows
            for i in np.flatnonzero(size > capacity).tolist():
                starts[i] = cuts(text[i].as_py().encode(), capacity)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(size), pa.array(starts, pa.list_(pa.int64()))], names=["id", "source", "cluster", "size", "starts"])

    return run


def pack(docs: DataFrame, capacity: int, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", slots: int = 4, shard_rows: int = 2048) -> DataFrame:
    """One row a piece: (id_col, piece, start, size, shard, bin, at). Sizes and offsets are UTF-8 bytes; a bin is (shard, bin).

    Full pieces of long texts have bin -1 - piece of shard `shard` and fill it alone; they are told apart by the document too.
    """
    if capacity < 4 or slots < 1:
        raise ValueError("capacity must be 4 or more (a character's bytes), slots 1 or more")
    shards = max(1, -(-docs.count() // shard_rows))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("null"))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), source.alias("source"), F.xxhash64(F.lower(F.trim(text))).alias("cluster"), text.alias("text"))
    rows = rows.mapInArrow(_measured(capacity), f"id {kind}, source string, cluster long, size long, starts array<long>")
    # Rows that repeat are counted and numbered, so that they spread by number wherever they lie; many copies by blocks of numbers.
    rows = rows.groupBy("id", "source", "cluster", "size", "starts").agg(F.count(F.lit(1)).alias("copies"))
    few = rows.where(F.col("copies") <= COPIES).withColumn("block", F.lit(0).cast("long"))
    many = rows.where(F.col("copies") > COPIES).withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / COPIES))))
    rows = few.unionByName(many.repartition("id", "cluster", "block"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.col("block") * COPIES, F.least(F.col("copies"), (F.col("block") + 1) * COPIES) - 1)))
    rows = rows.withColumn("_deal", F.xxhash64("id", "cluster", "copy"))
    rows = rows.withColumn("slot", F.concat(F.pmod("_deal", F.lit(slots)).cast("string"), "source"))
    rows = rows.withColumn("shard", F.pmod(F.shiftright("_deal", 8), F.lit(shards)).cast("int"))
    rows = rows.select("id", "size", "starts", "slot", "cluster", "shard", "_deal")

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by([("_deal", "ascending"), ("id", "ascending"), ("size", "descending")])
        size, starts = table.column("size").to_pylist(), [s or [0] for s in table.column("starts").to_pylist()]
        rest = [n - s[-1] for n, s in zip(size, starts, strict=True)]
        own = [i for i, n in enumerate(rest) if n]
        slot, cluster = table.column("slot").to_pylist(), table.column("cluster").to_pylist()
        places = dict(zip(own, best_fit([(rest[i], slot[i], cluster[i]) for i in own], capacity), strict=True))
        row, out = [], []
        for i, (n, begin) in enumerate(zip(size, starts, strict=True)):
            for k, (a, b) in enumerate(zip(begin, [*begin[1:], n], strict=True)):
                row.append(i)
                out.append((k, a, b - a, *(places.get(i, (None, None)) if k == len(begin) - 1 else (-1 - k, 0))))
        piece, start, sizes, bins, offset = zip(*out, strict=True) if out else ([],) * 5
        take = pa.array(row, pa.int64())
        return pa.table({"id": table.column("id").take(take), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()), "size": pa.array(sizes, pa.int64()), "shard": table.column("shard").take(take), "bin": pa.array(bins, pa.int32()), "at": pa.array(offset, pa.int64())})

    return rows.groupBy("shard").applyInArrow(packed, f"id {kind}, {PACKED}").withColumnRenamed("id", id_col)
