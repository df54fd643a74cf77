"""Line dedup by range-partitioned line hashes.

Lines become (128-bit key hash, doc, position) rows, range-partitioned by (hash, document) and sorted by (hash, document
descending, position). Each partition is read once as a stream. A very common line may span several partitions, so each
partition also reports its first and last run; those few summaries (two a partition) settle the runs that are open at an edge.
The result is a compressed keep bitmap for each document that loses lines, never text.

Defined results: a null or empty text is one empty line; rows with the same doc_id are one document, and a null doc_id is
one document, smaller than all others; repeated rows get the same decisions; only the id and text columns are read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leasegrid.llm.shared import carried, slices, written

SPACE = " \t\n\x0b\x0c\r"
LINES = "doc long, sig long, n_lines int, pos int, h1 long, h2 long"
FOUND = "kind int, doc long, sig long, n_lines int, pos int, h1 long, h2 long, n long"


def line_rows(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row for each line whose key has min_chars code points or more."""

    def split(batches):
        for batch in batches:
            for part in slices(batch, 2):
                lines = pc.split_pattern(pc.fill_null(part.column(2), ""), "\n")
                count = pc.list_value_length(lines).to_numpy(zero_copy_only=False).astype(np.int32)
                start = np.concatenate([[0], np.cumsum(count)])
                keys = pc.ascii_lower(pc.ascii_trim(pc.list_flatten(lines), SPACE))
                use = np.flatnonzero(pc.greater_equal(pc.utf8_length(keys), min_chars).to_numpy(zero_copy_only=False))
                row = np.repeat(np.arange(part.num_rows), count)[use]
                digest = b"".join(xxhash.xxh3_128_digest(k) for k in keys.take(pa.array(use)).cast(pa.binary()).to_pylist())
                hashes = np.frombuffer(digest, dtype=">i8").astype(np.int64).reshape(-1, 2)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take), pa.array(count[row], pa.int32()), pa.array((use - start[row]).astype(np.int32)), pa.array(hashes[:, 0]), pa.array(hashes[:, 1])],
                    schema=pa.schema([("doc", pa.int64()), ("sig", pa.int64()), ("n_lines", pa.int32()), ("pos", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64())]),
                )

    return docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("sig"), F.col(text_col).cast("string").alias("text")).mapInArrow(split, LINES)


def _streamed(least: int):
    """Reads one sorted partition. Kinds: 0 a line to drop, 1 a line whose run is open at an edge, 2 summary of the first or last run."""

    def found(batches):
        run, docs, top, last, first, pending = None, 0, None, None, True, []

        def rows(kind, picked, n=0):
            return [(kind, *r, n) for r in picked]

        def closed(final):
            """What is left to say when a run ends."""
            out = []
            if run is not None and (first or final):
                out += rows(1, pending) + rows(2, [(top, None, None, None, *run)], docs)
            return out

        for batch in batches:
            out = []
            # Rows alone in their run inside a batch can't be dropped; only runs of two rows or more, and edges, are walked.
            h1, h2 = batch.column(4).to_numpy(), batch.column(5).to_numpy()
            same = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])
            walk = np.concatenate([[True], same]) | np.concatenate([same, [True]])
            walk[0] = walk[-1] = True
            for r in zip(*(c.to_pylist() for c in batch.filter(pa.array(walk)).columns), strict=True):
                if (key := r[4:6]) != run:
                    out += closed(False)
                    first = run is None
                    run, docs, top, pending = key, 0, r[0], []
                    last = None
                if docs == 0 or r[0] != last:
                    docs, last = docs + 1, r[0]
                    if docs == least and not first:
                        out += rows(0, pending)
                        pending = []
                if first:
                    out += rows(1, [r])
                elif docs >= least:
                    out += rows(0, [r])
                elif docs > 1:
                    pending.append(r)
            if out:
                yield _batch(out)
        if out := closed(True):
            yield _batch(out)

    return found


def _batch(rows):
    names = ("kind", "doc", "sig", "n_lines", "pos", "h1", "h2", "n")
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], schema=pa.schema(list(zip(names, kinds, strict=True))))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 3, min_chars: int = 20) -> DataFrame:
    """(doc, sig, n_lines, n_dropped, keep_bitmap) for each document that loses lines; sig tells apart rows with one doc_id.

    keep_bitmap is zlib over packed bits, first line in the highest bit. A line key of min_chars code points or more found in
    min_docs documents or more stays only in the largest doc_id that holds it.
    """
    if min_docs < 2:
        raise ValueError("min_docs must be 2 or more")
    lines = written(line_rows(docs, id_col, text_col, min_chars), "lines")
    order = [F.col("h1"), F.col("h2"), F.col("doc").desc_nulls_last()]
    found = written(lines.repartitionByRange(*order).sortWithinPartitions(*order, "sig", "pos").mapInArrow(_streamed(min_docs), FOUND), "line-runs")
    edges = found.where("kind = 2").groupBy("h1", "h2").agg(F.sum("n").alias("docs"), F.max("doc").alias("top"))
    opened = found.where("kind = 1").join(F.broadcast(edges), ["h1", "h2"]).where((F.col("docs") >= min_docs) & ~F.col("doc").eqNullSafe(F.col("top")))
    drop = found.where("kind = 0").select("doc", "sig", "n_lines", "pos").union(opened.select("doc", "sig", "n_lines", "pos"))
    per_doc = drop.groupBy("doc", "sig").agg(F.max("n_lines").alias("n_lines"), F.collect_set("pos").alias("pos"))

    def packed(batches):
        for batch in batches:
            maps, gone = [], []
            for n, pos in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                keep = np.ones(n, dtype=np.uint8)
                keep[pos] = 0
                maps.append(zlib.compress(np.packbits(keep).tobytes()))
                gone.append(len(pos))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(gone, pa.int32()), pa.array(maps, pa.binary())], names=["doc", "sig", "n_lines", "n_dropped", "keep_bitmap"])

    return per_doc.mapInArrow(packed, "doc long, sig long, n_lines int, n_dropped int, keep_bitmap binary")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id_col, n_lines, n_dropped, text_col, and the columns in carry) for every row of docs, with the lines that its bitmap clears taken out."""
    texts = docs.select(F.col(id_col), F.col(id_col).cast("long").alias("_doc"), F.xxhash64(text_col).alias("_sig"), F.col(text_col).cast("string").alias("_text"), *carry)
    maps = bitmaps.select("doc", "sig", "keep_bitmap").hint("shuffle_hash")
    both = texts.join(maps, texts["_doc"].eqNullSafe(maps["doc"]) & (texts["_sig"] == maps["sig"]), "left").select(texts[id_col], texts["_text"], "keep_bitmap", *[texts[c] for c in carry])

    def kept(batches):
        for batch in batches:
            for part in slices(batch, 1):
                texts, lines, gone = [], [], []
                for text, bits in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    text = text or ""
                    n = text.count("\n") + 1
                    lost = 0
                    if bits is not None:
                        keep = np.unpackbits(np.frombuffer(zlib.decompress(bits), dtype=np.uint8), count=n).tolist()
                        lost = n - sum(keep)
                        text = "\n".join(x for x, k in zip(text.split("\n"), keep, strict=True) if k)
                    texts.append(text)
                    lines.append(n)
                    gone.append(lost)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lines, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.string()), *part.columns[3:]], names=[id_col, "n_lines", "n_dropped", text_col, *carry])

    kind = docs.schema[id_col].dataType.simpleString()
    more = carried(docs, carry, (id_col, "n_lines", "n_dropped", text_col))
    return both.mapInArrow(kept, f"`{id_col}` {kind}, n_lines long, n_dropped long, `{text_col}` string{more}")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 3, min_chars: int = 20) -> DataFrame:
    """Texts without their repeated lines: (id_col, n_lines, n_dropped, text_col), one row for each row of docs."""
    return apply_bitmaps(docs, keep_bitmaps(docs, id_col, text_col, min_docs, min_chars), id_col, text_col)
