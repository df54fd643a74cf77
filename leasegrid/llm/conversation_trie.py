"""Prefix trie of conversations by van Emde Boas recursion over their depth.

Sequences of turns are cut at half their depth. Cut prefixes get names; the upper trie and the forests below the cut prefixes are then
built side by side, by the same step at half the height: one round cuts all pieces of one height, so a depth of n takes log n rounds.
Afterwards totals are grafted: the forests' totals go up to the cut prefixes and on to the roots of pieces twice as high, then down
from the roots to the nodes inside the pieces, again a round for each height. Each round reads and writes what is of its height only.

A node is named by its smallest member and its depth; both sides of every join have one row for such a name, but for the pieces below
one cut prefix, which may be most of them: these are joined by join_hot. Equal sequences are one before the first round. Turns are
numbered by range partitions, so neither a conversation nor the copies of one meet in a task; the members that end in a node are
joined to texts in parallel, and one task only hashes those in order.

Defined results: turns are in order of (turn, nulls first; role; text); a null role or text is empty; rows with a null conv_id are not
read; repeated rows are turns of their own; an empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leasegrid.llm.shared import discard, join_hot, written

#: Characters of ids hashed as one piece.
CHUNK = 1 << 16
NOBODY = hashlib.sha256().hexdigest()


def _name(text: Column) -> Column:
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, position, name, bytes): turns of each conversation counted from 1; name stands for role and text."""
    filled = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *filled).where("conv_id is not null")
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    name = _name(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", name.alias("name"), F.octet_length("text").alias("bytes"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    rows = written(rows, "turns")
    # A row for each conversation and each partition that has turns of it.
    spans = rows.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("n")
    spans = spans.select("conv_id", "part", "first", before.alias("before"))
    return rows.join(spans, ["conv_id", "part"]).select("conv_id", (F.col("at") - F.col("first") + F.col("before") + 1).alias("position"), "name", "bytes")


def _chunks(batches):
    """Ids of sorted (name, conv_id) rows, joined by commas."""
    name, ids, size, made = None, [], 0, []

    def closed():
        return [(name, ids[0], len(ids), ",".join(map(str, ids)))] if ids else []

    for batch in batches:
        for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if key != name or size >= CHUNK:
                made += closed()
                name, ids, size = key, [], 0
            ids.append(conv)
            size += len(str(conv)) + 1
        yield _batch(made)
        made = []
    yield _batch(closed())


def _batch(rows):
    kinds = {"name": pa.binary(), "first": pa.int64(), "n": pa.int64(), "ids": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds.values())], names=list(kinds))


def _folded(batches):
    """One row for each name of sorted chunks; the last column is the hash of all its ids."""
    name, first, n, sha, made = None, None, 0, None, []
    for batch in batches:
        for key, start, count, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if sha is None or key != name:
                made += [(name, first, n, sha.hexdigest())] if sha else []
                name, first, n, sha = key, start, 0, hashlib.sha256()
            sha.update(((("," if n else "") + ids)).encode())
            n += count
        yield _batch(made)
        made = []
    yield _batch([(name, first, n, sha.hexdigest())] if sha else [])


def _members(convs: DataFrame) -> DataFrame:
    """(name, rep, n, ends) of each name of convs (name, conv_id): smallest member, number, and hash of all its members."""
    order = ["name", "conv_id"]
    chunks = convs.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_chunks, "name binary, first long, n long, ids string")
    hashed = chunks.repartition("name").sortWithinPartitions("name", "first").mapInArrow(_folded, "name binary, first long, n long, ids string")
    return hashed.select("name", F.col("first").alias("rep"), "n", F.col("ids").alias("ends"))


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row for each distinct beginning of the conversations, from the empty one: see the columns of `nodes` below.

    turns: (conv_id, position from 1 without gaps, name, bytes); convs: every conv_id once, also those without turns.
    """
    blocks = [written(turns.select("conv_id", (F.col("position") - 1).alias("o"), "name", "bytes", F.lit(1).cast("long").alias("size")), "blocks")]
    depth = blocks[0].agg(F.max("o")).first()[0]
    height = 0 if depth is None else int(depth).bit_length()
    # Names of ever longer blocks of turns, aligned to their length.
    for _ in range(height):
        half = lambda c, right: F.max(F.when(F.col("o") % 2 == right, F.col(c)))
        pairs = blocks[-1].groupBy("conv_id", F.floor(F.col("o") / 2).alias("o")).agg(half("name", 0).alias("left"), half("name", 1).alias("right"), F.sum("size").alias("size"))
        blocks.append(written(pairs.select("conv_id", "o", _name(F.concat("left", F.coalesce("right", F.lit(b"")))).alias("name"), "left", F.col("right").isNotNull().alias("more"), "size"), "blocks"))
    whole = convs.select("conv_id").join(blocks[-1].select("conv_id", "name"), "conv_id", "left").select(F.coalesce("name", F.lit(b"")).alias("name"), "conv_id")
    members = written(_members(whole), "members")
    root, everyone = members.agg(F.min("rep"), F.sum("n")).first()
    if root is None:
        root, everyone = 0, 0
    nobody = F.lit(None).cast("long")
    # Pieces of one height: ctx is the node above (its depth is o heights), rep the smallest of the n members, end the members that end inside.
    pieces = members.where(F.length("name") > 0).select(F.lit(root).cast("long").alias("ctx"), F.lit(0).cast("long").alias("o"), "rep", "n", F.col("rep").alias("end"))
    links = {}
    for k in range(height, 0, -1):
        here = blocks[k].select(F.col("conv_id").alias("rep"), "o", "left", "more", "size")
        key = F.concat_ws(":", "ctx", "o", F.hex("left"))
        cut = written(pieces.join(here, ["rep", "o"]).withColumn("key", key), "pieces")
        links[k] = cut.where(F.col("size") == 1 << k).select("ctx", "o", "rep")
        total = cut.count()
        upper = cut.groupBy("key", "ctx", "o").agg(F.min("rep").alias("rep"), F.sum("n").alias("n"), F.max(F.when(~F.col("more"), F.col("end"))).alias("end"), F.count(F.lit(1)).alias("rows"))
        lower = join_hot(cut.where("more"), upper.select("key", F.col("rep").alias("up"), "rows"), "key", "rows", total)
        both = upper.select("ctx", (F.col("o") * 2).alias("o"), "rep", "n", "end").unionByName(lower.select(F.col("up").alias("ctx"), (F.col("o") * 2 + 1).alias("o"), "rep", "n", "end"))
        before, pieces = pieces, written(both, "pieces")
        discard(before)
    made = pieces.join(blocks[0].select(F.col("conv_id").alias("rep"), "o", "bytes"), ["rep", "o"])
    made = made.select(F.col("rep").alias("conv_id"), (F.col("o") + 1).alias("depth"), F.col("ctx").alias("parent_conv_id"), "n", "end", ((F.col("n") - 1) * F.col("bytes")).alias("saved"))
    children = pieces.groupBy(F.col("ctx").alias("conv_id"), F.col("o").alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    top = members.agg(F.max(F.when(F.length("name") == 0, F.col("rep"))).alias("end"), F.count(F.lit(1)).alias("any")).where(F.col("any") > 0)
    top = top.select(F.lit(root).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), nobody.alias("parent_conv_id"), F.lit(everyone).cast("long").alias("n"), "end", F.lit(0).cast("long").alias("saved"))
    nodes = made.unionByName(top).join(children, ["conv_id", "depth"], "left").fillna({"n_children": 0})
    nodes = written(nodes.withColumn("leaf", (F.col("n_children") == 0).cast("long")), "nodes")
    links[0] = nodes.where("depth > 0").select(F.col("parent_conv_id").alias("ctx"), (F.col("depth") - 1).alias("o"), F.col("conv_id").alias("rep"))
    below = _grafted(nodes, links, height)
    ends = members.select(F.col("rep").alias("end"), "ends")
    out = nodes.join(below, ["conv_id", "depth"], "left").join(ends, "end", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", (F.col("leaf") + F.coalesce("leaves_below", F.lit(0))).alias("n_leaves"),
        (F.col("saved") + F.coalesce("saved_below", F.lit(0))).alias("saved_tokens"), F.coalesce("ends", F.lit(NOBODY)).alias("ends_sha256"),
    )


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("conv_id", "depth").agg(F.sum("leaves_below").alias("leaves_below"), F.sum("saved_below").alias("saved_below"))


def _sent(totals: DataFrame, links: DataFrame, k: int, odd: int) -> DataFrame:
    """Totals of the nodes at the ends of pieces of height 2^k, given to the nodes those pieces begin at; of every other piece only."""
    ways = links.where(F.col("o") % 2 == odd).select(F.col("rep").alias("conv_id"), ((F.col("o") + 1) * (1 << k)).alias("depth"), "ctx", (F.col("o") * (1 << k)).alias("start"))
    return ways.join(totals, ["conv_id", "depth"]).select(F.col("ctx").alias("conv_id"), F.col("start").alias("depth"), "leaves_below", "saved_below")


def _grafted(nodes: DataFrame, links: dict[int, DataFrame], height: int) -> DataFrame:
    """(conv_id, depth, leaves_below, saved_below) of every node with nodes below it: totals of all of those."""
    first = nodes.where("depth > 0").select(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"), F.col("leaf").alias("leaves_below"), F.col("saved").alias("saved_below"))
    near = [written(_summed(first), "totals")]
    for k in range(1, height + 1):
        up = near[-1].where(F.col("depth") % (1 << k) == 0).unionByName(_sent(near[-1], links[k - 1], k - 1, 0))
        near.append(written(_summed(up), "totals"))
    # From the root to the middles of ever lower pieces.
    whole = near[height]
    for k in range(height, 0, -1):
        own = near[k - 1].where(F.col("depth") % (1 << k) == 1 << (k - 1))
        whole = whole.unionByName(written(_summed(own.unionByName(_sent(whole, links[k - 1], k - 1, 1))), "totals"))
    return whole


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, convs) as prefix_trie takes them, of conversations that begin with turns of the first of their five.

    Conversation c gets the first h turns of conversation c - c % 5, then its own after its first h; h is its checksum's remainder by 9.
    """
    rows = written(numbered(turns), "numbered")
    sizes = turns.select(F.col("conv_id").cast("long").alias("conv_id")).where("conv_id is not null").groupBy("conv_id").agg(F.count(F.lit(1)).alias("rows"))
    total = rows.count()
    convs = sizes.select("conv_id", "rows", (F.col("conv_id") - F.col("conv_id") % 5).alias("base"), (F.crc32(F.col("conv_id").cast("string")) % 9).alias("h"))
    heads = sizes.select(F.col("conv_id").alias("base"), F.col("rows").alias("there"))
    convs = written(convs.join(heads, "base", "left").withColumn("head", F.least("h", F.coalesce("there", F.lit(0)))), "convs")
    own = join_hot(rows, convs.select("conv_id", "rows", "h", "head"), "conv_id", "rows", total).where("position > h").select("conv_id", (F.col("position") - F.col("h") + F.col("head")).alias("position"), "name", "bytes")
    begun = rows.where("position <= 8").withColumnRenamed("conv_id", "base").join(convs.select("conv_id", "base", "h"), "base").where("position <= h")
    return own.unionByName(begun.select("conv_id", "position", "name", "bytes")), convs.select("conv_id")


def trie_of_rebuilt(turns: DataFrame) -> DataFrame:
    return prefix_trie(*rebuilt(turns))
