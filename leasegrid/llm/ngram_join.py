"""N-gram Jaccard join: which documents share at least `percent` % of their distinct word n-grams.

1. Every text becomes a sorted array of 64-bit n-gram hashes; 64 bits of a digest of it make equal sets one, all 128 find its text again.
2. n-grams in a large share of all documents (counted over all of them) are put last in the order that picks each set's prefix,
   so passages that many documents share rarely become keys. Any one order is exact: sets of the wanted similarity share a key
   of their prefixes.
3. Keys are dealt to buckets in packed blocks; keys held by one set are dropped there. The postings of a frequent n-gram are dealt by
   set, so no task holds all of one.
4. First links: each set against the sets that its keys suggest most. Only keys whose sets are still in different components
   go on (closest pairs first, then every pair), as size-banded tiles: sets of a key are split by size band and into bounded blocks, and compared by their bitmaps.
   A parity bitmap with as many bits as the set has n-grams bounds the overlap from above by its bit count.
5. Pairs that pass are settled by exact intersection of the sorted arrays, one set against its partners at a time. A set's array
   is made again from its text once, however many rounds it takes part in.

No pair is dropped or capped. Pairs inside one component need no look: what is returned is every row's component.
Hash collisions aside (64 bits), results are exact.

Defined results: a null or empty text has no n-grams and links with nothing; fewer than n words make one n-gram; rows with a
null doc_id link with nothing and get a null component; rows with one doc_id are one document in components; only the id and
text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leasegrid.llm.shared import connected, discard, join_hot, slices, written

HEAVY_CHUNK = 4_000_000
#: Most n-grams that count as frequent; the most frequent ones.
HEAVY = 1 << 20
BLOCK = 512
#: Pairs of sets that are looked at together.
PAIRS = 1 << 18
#: Partners that a set is first tried with.
FIRST = 3
M = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = pc.list_flatten(words)
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))])
    at = np.concatenate([[0], np.cumsum(full)])[ends]
    coded = pc.dictionary_encode(flat.filter(pa.array(full)))
    each = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()], dtype=np.uint64)
    h = each[coded.indices.to_numpy()] if len(each) else np.zeros(0, np.uint64)
    total = np.zeros(max(0, len(h) - n + 1), dtype=np.uint64)
    for k in range(n):
        total = total * M + h[k : k + len(total)]
    total = mixed(total + np.uint64(n))
    out = []
    for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if j - i >= n:
            s = np.sort(total[i : j - n + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif j > i:
            few = np.zeros(1, np.uint64)
            for k in range(i, j):
                few = few * M + h[k : k + 1]
            out.append(mixed(few + np.uint64(j - i)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def parity_bits(s: np.ndarray) -> np.ndarray:
    """As many bits as the next power of two of the set's size, 64 at least; each element flips one. Halves fold by xor."""
    bits = max(64, 1 << int(len(s) - 1).bit_length())
    return np.packbits((np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8))


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    while bits.shape[-1] > size:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def least_shared(total, percent: int):
    """The smallest overlap that links two sets of `total` elements together: 100 * o >= percent * (total - o)."""
    return -(-percent * total // (100 + percent))


def _sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))


def heavy_shingles(docs: DataFrame, n: int, share: int) -> np.ndarray:
    """Sorted n-grams that at least one in `share` documents holds, counted over all documents by runs of up to HEAVY_CHUNK.

    A run reports what it holds in at least one in 2 * share of its documents. At most share * (mean set size) n-grams
    can be that frequent, however many documents there are, and of those the HEAVY most frequent are taken; that bounds what is
    broadcast. All others are held by at most one in share documents, or by (mean set size) / HEAVY of them.
    """

    def counted(batches):
        held, size, docs = [], 0, 0

        def flush():
            all_, count = np.unique(np.concatenate(held), return_counts=True)
            often = count >= max(4, docs // (2 * share))
            return pa.RecordBatch.from_arrays([pa.array(all_[often].view(np.int64)), pa.array(count[often], pa.int64())], names=["key", "n"])

        for batch in batches:
            for part in slices(batch, 0):
                for s in shingle_sets(part.column(0), n):
                    held.append(s)
                    size, docs = size + len(s), docs + 1
                    if size >= HEAVY_CHUNK:
                        yield flush()
                        held, size, docs = [], 0, 0
        if held:
            yield flush()

    texts = docs.where("doc is not null")
    least = max(8, texts.count() // share)
    keys = texts.select("text").mapInArrow(counted, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).orderBy(F.desc("n"), "key").limit(HEAVY).select("key")
    return np.sort(keys.toPandas()["key"].to_numpy(dtype=np.int64).view(np.uint64))


def _among(heavy: np.ndarray, s: np.ndarray) -> np.ndarray:
    if not len(heavy):
        return np.zeros(len(s), bool)
    return heavy[np.minimum(np.searchsorted(heavy, s), len(heavy) - 1)] == s


def _prefix(s: np.ndarray, heavy: np.ndarray, percent: int) -> np.ndarray:
    p = len(s) + (-percent * len(s) // 100) + 1
    if _among(heavy, s[:p]).any():
        often = _among(heavy, s)
        s = np.concatenate([s[~often], s[often]])
    return s[:p]


def _dealt(docs: DataFrame, n: int, percent: int, heavy, buckets: int) -> DataFrame:
    """kind 0: a document's row; kind 1: a block of (key, set) postings of one bucket, dealt by key; kind 2: by key and set."""

    def deal(batches):
        from array import array

        have = heavy.value
        seen, keys, sets, size = set(), [], array("q"), 0
        counts = []

        def blocks():
            k = np.concatenate(keys)
            ids = np.repeat(np.frombuffer(sets, dtype=np.int64), counts)
            often = _among(have, k)
            where = (np.where(often, mixed(k ^ ids.view(np.uint64)), k) >> np.uint64(40)).astype(np.int64) % buckets * 2 + often
            order = np.argsort(where, kind="stable")
            cut = np.searchsorted(where[order], np.arange(2 * buckets + 1))
            k, ids = k[order], ids[order]
            for b in range(2 * buckets):
                if cut[b] < cut[b + 1]:
                    yield (1 + b % 2, b // 2, None, None, None, None, None, k[cut[b] : cut[b + 1]].tobytes() + ids[cut[b] : cut[b + 1]].tobytes())

        for batch in batches:
            for part in slices(batch, 1):
                rows = []
                for doc, s in zip(part.column(0).to_pylist(), shingle_sets(part.column(1), n), strict=True):
                    if not len(s):
                        rows.append((0, xxhash.xxh3_64_intdigest(str(doc)) % buckets, doc, 0, None, None, None, None))
                        continue
                    hi, lo = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), dtype=np.int64).tolist()
                    rows.append((0, xxhash.xxh3_64_intdigest(str(doc)) % buckets, doc, len(s), hi, lo, parity_bits(s).tobytes(), None))
                    if hi not in seen:
                        seen.add(hi)
                        p = _prefix(s, have, percent)
                        keys.append(p)
                        counts.append(len(p))
                        sets.append(hi)
                        size += len(p)
                if size >= HEAVY_CHUNK // 2:
                    rows += blocks()
                    keys, counts, size, sets = [], [], 0, array("q")
                yield _rows(rows)
        if size:
            yield _rows(list(blocks()))

    return docs.mapInArrow(deal, DEALT)


DEALT = "kind int, bucket int, doc long, n long, set long, low long, bits binary, block binary"
_NAMES = ["kind", "bucket", "doc", "n", "set", "low", "bits", "block"]
_KINDS = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]


def _rows(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _KINDS, strict=True)], names=_NAMES)


def _gathered(batches):
    """One partition of whole buckets: passes documents' rows on and gives the postings of keys that two sets or more hold."""
    keys, sets = {1: [], 2: []}, {1: [], 2: []}
    for batch in batches:
        docs = batch.filter(pc.equal(batch.column(0), 0))
        if docs.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(docs.num_rows, np.int64)), *(docs.column(c) for c in (2, 3, 4, 5, 6))], names=["key", "doc", "n", "set", "low", "bits"])
        for kind in (1, 2):
            for block in batch.filter(pc.equal(batch.column(0), kind)).column(7).to_pylist():
                both = np.frombuffer(block, dtype=np.uint64).reshape(2, -1)
                keys[kind].append(both[0])
                sets[kind].append(both[1].view(np.int64))
    for kind in (1, 2):
        if not keys[kind]:
            continue
        k, s = np.concatenate(keys.pop(kind)), np.concatenate(sets.pop(kind))
        order = np.lexsort((s, k))
        k, s = k[order], s[order]
        new = np.concatenate([[True], (k[1:] != k[:-1]) | (s[1:] != s[:-1])])
        k, s = k[new], s[new]
        if kind == 1:
            same = k[1:] == k[:-1]
            use = np.concatenate([[False], same]) | np.concatenate([same, [False]])
            k, s = k[use], s[use]
        k = k.view(np.int64)
        for at in range(0, len(k), 100_000):
            none = pa.nulls(len(k[at : at + 100_000]), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(k[at : at + 100_000]), none, none, pa.array(s[at : at + 100_000]), none, pa.nulls(len(none), pa.binary())], names=["key", "doc", "n", "set", "low", "bits"])


def _bounded(percent: int):
    """Of candidate pairs with sizes and bitmaps, those whose bit count allows the overlap."""

    def passed(batches):
        for batch in batches:
            na, nb = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            ok = np.zeros(batch.num_rows, dtype=bool)
            for i, (x, y) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)):
                x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
                low = min(len(x), len(y))
                differ = int(np.bitwise_count(fold(x, low) ^ fold(y, low)).sum())
                ok[i] = (na[i] + nb[i] - differ) // 2 >= least_shared(na[i] + nb[i], percent)
            yield batch.filter(pa.array(ok)).select(["a", "b"])

    return passed


def _differing(own: np.ndarray, first: np.ndarray, bits):
    """A function of index arrays u, v into `own` that counts the bits in which two sets' bitmaps differ, folded to the narrower."""
    bits = bits.take(pa.array(first))
    width = pc.binary_length(bits).to_numpy().astype(np.int64)
    held, spot = {}, np.empty(len(own), np.int64)
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        spot[rows] = np.arange(len(rows))
        held[w] = np.frombuffer(b"".join(bits.take(pa.array(rows)).to_pylist()), np.uint8).reshape(-1, w)

    def differ(u: np.ndarray, v: np.ndarray) -> np.ndarray:
        out = np.empty(len(u), np.int64)
        kinds = width[u] * (1 << 32) + width[v]
        for kind in np.unique(kinds).tolist():
            of = np.flatnonzero(kinds == kind)
            wu, wv = kind >> 32, kind & (1 << 32) - 1
            low = min(wu, wv)
            x, y = fold(held[wu], low).view(np.uint64), fold(held[wv], low).view(np.uint64)
            step = max(1, (4 << 20) // low)
            for k in range(0, len(of), step):
                at = of[k : k + step]
                out[at] = np.bitwise_count(x[spot[u[at]]] ^ y[spot[v[at]]]).sum(axis=1, dtype=np.int64)
        return out

    return differ


def _tile_pairs(tile, ids, n, comp, side, bits, percent: int, nearest: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of sets that may link, by sizes and bit counts, of all given tiles at once.

    tile: each row's tile as an ascending number from 0. side: 0 left, 1 right, 2 both. The smaller set is on the left.
    With `nearest`, each left row gives only its so many closest partners by bit count: the cheap round that comes first.
    """
    # By size within tiles, a row's possible partners are the rows that follow it up to the largest size it can link with.
    order = np.lexsort((ids, n, tile))
    tile, ids, n, comp, side = tile[order], ids[order], n[order], comp[order], side[order]
    most = 100 * n // percent
    far = int(most.max()) + 1
    partners = np.searchsorted(tile * far + n, tile * far + most, side="right") - np.arange(len(n)) - 1
    own, first, at = np.unique(ids, return_index=True, return_inverse=True)
    differing = _differing(own, order[first], bits)
    size = n[first]
    start = np.searchsorted(tile, np.arange(tile[-1] + 2))
    upto = np.concatenate([[0], np.cumsum(partners)])[start]
    found, t = [], 0
    while t < len(start) - 1:
        # Whole tiles of up to PAIRS pairs together; a single larger tile comes alone.
        end = max(t + 1, int(np.searchsorted(upto, upto[t] + PAIRS, side="right")) - 1)
        rows = np.arange(start[t], start[end])
        many = partners[rows]
        i = np.repeat(rows, many)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many)
        near = (comp[i] != comp[j]) & (side[i] != 1) & (side[j] != 0)
        i, j, t = i[near], j[near], end
        codes, back = np.unique(at[i] * len(own) + at[j], return_inverse=True)
        u, v = codes // len(own), codes % len(own)
        differ = differing(u, v)
        ok = (size[u] + size[v] - differ) // 2 >= least_shared(size[u] + size[v], percent)
        if nearest is not None:
            i, j, differ, codes_of = i[ok[back]], j[ok[back]], differ[back][ok[back]], codes[back][ok[back]]
            order = np.lexsort((ids[j], differ, i))
            i = i[order]
            new = np.concatenate([[True], i[1:] != i[:-1]])[: len(i)]
            begun = np.flatnonzero(new)
            found.append(codes_of[order][np.arange(len(i)) - np.repeat(begun, np.diff(np.append(begun, len(i)))) < nearest])
        else:
            found.append(codes[ok])
    codes = np.unique(np.concatenate(found))
    return own[codes // len(own)], own[codes % len(own)]


def _tiled(percent: int, nearest: int | None):
    """Walks a partition sorted by tile; a tile (key, band, x, y) has a bounded number of rows."""

    def starts(table):
        tile = np.stack([table.column(c).to_numpy() for c in ("key", "band", "x", "y")])
        return (tile[:, 1:] != tile[:, :-1]).any(axis=0)

    def pairs(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            if rest.num_rows >= 10_000:
                cut = np.flatnonzero(starts(rest))
                if len(cut):
                    yield done(rest.slice(0, cut[-1] + 1))
                    rest = rest.slice(cut[-1] + 1)
        if rest is not None and rest.num_rows:
            yield done(rest)

    def done(table):
        tile = np.concatenate([[0], np.cumsum(starts(table))])
        ids, n, comp, side = (table.column(c).to_numpy() for c in ("set", "n", "comp", "side"))
        x, y = _tile_pairs(tile, ids, n, comp, side, table.column("bits"), percent, nearest)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

    return pairs


def _exact(percent: int):
    """Exact intersection of one set with its partners, dealt in chunks that each hold a copy of that set."""

    def linked(batches):
        lead = {}
        for batch in batches:
            a, b = [], []
            for x, y, chunk, block in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "chunk", "block")), strict=True):
                s = np.frombuffer(block, dtype=np.uint64)
                if y is None:
                    lead = {(x, chunk): s}
                    continue
                other = lead[(x, chunk)]
                spot = np.searchsorted(other, s)
                spot[spot == len(other)] = 0
                if int((other[spot] == s).sum()) >= least_shared(len(s) + len(other), percent):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return linked


def _verified(pairs: DataFrame, reps: DataFrame, docs: DataFrame, n: int, percent: int, have: list[DataFrame]) -> DataFrame:
    """Of the distinct pairs (a, b), those that link. Sets that take part and aren't in `have` are made from their texts and added."""
    chunks = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(64)).cast("int").alias("chunk"))
    need = chunks.select(F.col("a").alias("set")).union(chunks.select("b")).distinct()
    for table in have:
        need = need.join(table.select("set"), "set", "left_anti")
    need = need.join(reps.select("set", "doc", "low"), "set")
    texts = docs.join(need.hint("shuffle_hash"), "doc").select("set", "low", "text")

    def made(batches):
        for batch in batches:
            for part in slices(batch, 2):
                blocks = [s.tobytes() for s in shingle_sets(part.column(2), n)]
                own = [np.frombuffer(xxhash.xxh3_128_digest(x), dtype=np.int64).tolist() == [hi, lo] for x, hi, lo in zip(blocks, part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(blocks, pa.binary())], names=["set", "block"]).filter(pa.array(own))

    # Of rows with one doc_id, more than one may give the set; a second copy changes nothing.
    have.append(written(texts.mapInArrow(made, "set long, block binary"), "sets"))
    sets = have[0]
    for table in have[1:]:
        sets = sets.unionByName(table)
    lead = chunks.select(F.col("a").alias("set"), "chunk").distinct().join(sets, "set").select(F.col("set").alias("a"), F.lit(None).cast("long").alias("b"), "chunk", "block")
    other = chunks.withColumnRenamed("b", "set").join(sets, "set").select("a", F.col("set").alias("b"), "chunk", "block")
    dealt = lead.unionByName(other).repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())
    return written(dealt.mapInArrow(_exact(percent), "a long, b long"), "links")


def _open_pairs(posts: DataFrame, reps: DataFrame, near: DataFrame, percent: int, nearest: int | None) -> DataFrame:
    """Distinct pairs of sets in different components that share a key and may link by their bit counts."""
    left = written(posts.join(near.withColumnRenamed("node", "set"), "set", "left").select("key", "set", "n", F.coalesce("component", "set").alias("comp")), "left")
    open_ = left.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo <> hi").select("key", "size", F.col("size").alias("rows"))
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent))).cast("int")
    tiles = join_hot(left, open_, "key", "rows", left.count()).select("key", "set", "n", "comp", band.alias("band"), F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    tiles = tiles.join(reps.select("set", "bits"), "set").withColumn("block", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int"))
    # Keys of one block are one tile. Else a set is on the left of its own band and on the right of its own and the one
    # below, and blocks of a key meet in every pair.
    head = ["key", "set", "n", "comp", "bits"]
    lone = tiles.where("blocks = 1").select(*head, F.lit(2).alias("side"), F.lit(-1).alias("band"), F.lit(0).alias("x"), F.lit(0).alias("y"))
    tiles = tiles.where("blocks > 1").withColumn("other", F.sequence(F.lit(0), F.col("blocks") - 1))
    lefts = tiles.select(*head, F.lit(0).alias("side"), "band", F.col("block").alias("x"), F.explode("other").alias("y"))
    rights = tiles.select(*head, F.lit(1).alias("side"), F.explode(F.array("band", F.col("band") - 1)).alias("band"), "block", "other")
    rights = rights.select(*head, "side", "band", F.explode("other").alias("x"), F.col("block").alias("y"))
    by = ["key", "band", "x", "y"]
    out = lone.unionByName(lefts).unionByName(rights).repartition(*by).sortWithinPartitions(*by).mapInArrow(_tiled(percent, nearest), "a long, b long").distinct()
    out = written(out, "pairs")
    discard(left)
    return out


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80, share: int = 2000, buckets: int | None = None) -> DataFrame:
    """(id_col, n_shingles, component_id) for each row of docs; component_id is the smallest id reachable by links, itself included."""
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    spark = docs.sparkSession
    parts = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = buckets or 4 * parts
    docs = _sets(docs, id_col, text_col)
    heavy = spark.sparkContext.broadcast(heavy_shingles(docs, n, share))
    dealt = _dealt(docs, n, percent, heavy, buckets).repartition(parts, "bucket")
    found = written(dealt.mapInArrow(_gathered, "key long, doc long, n long, set long, low long, bits binary"), "ngram-postings")
    every = found.where("key = 0 and n is not null")
    rows = written(every.select("doc", "n", "set"), "ngram-rows")
    reps = every.where("doc is not null and set is not null").groupBy("set").agg(F.min(F.struct("doc", "low", "n", "bits")).alias("r")).select("set", "r.doc", "r.low", "r.n", "r.bits")
    reps = written(reps, "ngram-sets")
    posts = found.where("n is null").select("key", "set").join(reps.select("set", "n"), "set")

    # First links: of each key, the set with most shared keys (the likely origin of copies) against the others; a set
    # is tried with the FIRST such partners that it shares most keys with.
    posts = written(posts.join(posts.groupBy("set").agg(F.count(F.lit(1)).alias("shared")), "set"), "shared")
    discard(found)
    lead = posts.groupBy("key").agg(F.max(F.struct("shared", "set")).alias("r"), F.count(F.lit(1)).alias("rows")).select("key", F.col("r.set").alias("a"), "rows")
    pairs = join_hot(posts, lead, "key", "rows", posts.count()).where("set <> a").groupBy("a", F.col("set").alias("b")).agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("nb"))
    best = Window.partitionBy("b").orderBy(F.desc("c"), "a")
    pairs = pairs.withColumn("r", F.row_number().over(best)).where(F.col("r") <= FIRST).select("a", "b", "nb")
    a, b = reps.select(F.col("set").alias("a"), F.col("n").alias("na"), F.col("bits").alias("ba")), reps.select(F.col("set").alias("b"), F.col("bits").alias("bb"))
    pairs = pairs.join(a, "a").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).join(b, "b").select("a", "b", "na", "nb", "ba", "bb")
    pairs, sets = written(pairs.mapInArrow(_bounded(percent), "a long, b long"), "pairs"), []
    links = _verified(pairs, reps, docs, n, percent, sets)
    discard(pairs)

    # What is left: keys whose sets lie in different components; each set's closest partners first, then every pair.
    for nearest in (FIRST, None):
        near = written(connected(links), "near")
        more = _open_pairs(posts, reps, near, percent, nearest)
        discard(near)
        if not more.limit(1).count():
            break
        found = _verified(more, reps, docs, n, percent, sets)
        before, links = links, written(links.union(found), "links")
        discard(more, found, before)
    discard(posts, *sets)

    # Rows that share a set or a doc_id are one; the smallest document of each set stands for it.
    rep = written(reps.select("set", F.col("doc").alias("rep")), "reps")
    discard(reps)
    own = rows.where("doc is not null and set is not null").join(rep, "set").select("doc", "n", "rep")
    ends = links.join(rep.select(F.col("set").alias("a"), F.col("rep").alias("ra")), "a").join(rep.select(F.col("set").alias("b"), F.col("rep").alias("rb")), "b").select("ra", "rb")
    groups = connected(ends.union(own.select("rep", "doc")), "ra", "rb").select(F.col("node").alias("doc"), "component")
    discard(rep, links)
    return rows.join(groups, "doc", "left").select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id"))
