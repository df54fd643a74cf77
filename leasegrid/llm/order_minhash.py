"""Order MinHash fingerprints: tuples of minimal k-mers in text order, so that likeness follows edit distance. DataFrame operations only.

A text's k-mers are its runs of k words, each numbered by how often it came before, so that repeats count. Every numbered k-mer has
a pseudo-random rank. A sketch has a point on the ring of ranks and takes the `take` k-mers that come next after it; as ranks are
random, each k-mer is next with equal chance, which is a minimum under a permutation of its own. The taken k-mers are put back in
text order and hashed as one tuple: sketches of two texts agree if they take the same k-mers in the same order. All of a text's
work is done in its own row on arrays of longs (36 bits of hash or rank above 27 of position), sorted three times: nothing is
exploded, and no row leaves its partition.

Defined results: a null text is empty; texts without words have one empty k-mer, and those with fewer than k words have one k-mer of
all of them; equal texts have equal fingerprints, and texts that differ in white space only, too. The next document is that of the next
larger id, after the largest the smallest; of several rows with that id, one is taken by the hash of its text. A row without id has
no next document (its edit only loses its end, near_next is 0) and is nobody's next. Repeated rows give a row each. Positions hold
texts of up to 134 million words, more than a row can. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leasegrid.llm.shared import written

#: Bits of a position; what is above them is hash or rank.
BITS = 27
MASK = (1 << BITS) - 1
#: Hexadecimal digits of one sketch of a fingerprint.
DIGITS = 4


def _high(x: Column) -> Column:
    return F.shiftright(x, BITS)


def _begins(s: Column) -> Column:
    return F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (_high(F.get(s, i)) != _high(F.get(s, i - 1))))


def _numbers(begins: Column, n: Column) -> Column:
    """0, 1, ... in each run."""
    return F.flatten(F.transform(begins, lambda b, j: F.sequence(F.lit(0), F.coalesce(F.get(begins, j + 1), n) - b - 1)))


def _tuple_hash(ranks: Column, take: int):
    """Of a point's place p among ranks and points, and its number j: the hash of the next `take` ranks, in text order."""
    low = F.lit((1 << 64 - BITS - 1) - 1)

    def made(p: Column, j: Column) -> Column:
        taken = F.transform(F.array(*map(F.lit, range(take))), lambda t: F.get(ranks, (p - j + t) % F.size(ranks)))
        turned = F.sort_array(F.transform(taken, lambda x: F.shiftleft(x.bitwiseAND(F.lit(MASK)), 64 - BITS - 1) + _high(x).bitwiseAND(low)))
        mixed = F.xxhash64(F.transform(turned, lambda x: x.bitwiseAND(low)))
        return F.lpad(F.hex(mixed.bitwiseAND(F.lit((1 << 4 * DIGITS) - 1))), DIGITS, "0")

    return made


def sketched(df: DataFrame, texts: dict[str, str], k: int = 5, take: int = 2, sketches: int = 64) -> DataFrame:
    """df with a binary fingerprint column for each text column, {fingerprint: text}; the texts go.

    Each step is a projection of its own, so that no array is computed again for each element of another.
    """
    if k < 1 or take < 1 or not 1 <= sketches <= 4096:
        raise ValueError("k and take must be 1 or more, sketches 1 to 4096")
    least = -(1 << 63)
    points = [least + (((1 << 64) * j // sketches) >> BITS << BITS) for j in range(sketches)]

    def step(make) -> None:
        nonlocal df
        df = df.withColumns({name: make(F.col(name)) for name in texts})

    df = df.withColumns({name: F.transform(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), ""), lambda w: F.xxhash64(w)) for name, text in texts.items()}).drop(*texts.values())
    # Positions count from 1: what ends in zeros is a point of the ring.
    put = lambda value, at: F.shiftleft(_high(value), BITS) + at
    step(lambda w: F.sort_array(F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - k, F.lit(0))), lambda i: put(F.xxhash64(*[F.get(w, i + d) for d in range(k)]), i + 1))))
    # Equal k-mers stand together, in text order: runs begin where the hash changes.
    df = df.withColumns({f"_{name}": _begins(F.col(name)) for name in texts})
    df = df.withColumns({f"_{name}": _numbers(F.col(f"_{name}"), F.size(name)) for name in texts})
    df = df.withColumns({name: F.zip_with(name, f"_{name}", lambda e, o: put(F.xxhash64(_high(e), o), e.bitwiseAND(F.lit(MASK)))) for name in texts})
    df = df.withColumns({f"_{name}": F.sort_array(F.concat(name, F.array(*map(F.lit, points)))) for name in texts} | {name: F.sort_array(name) for name in texts})
    # Where each point stands among the ranks.
    df = df.withColumns({f"_{name}": F.array_compact(F.transform(f"_{name}", lambda x, i: F.when(x.bitwiseAND(F.lit(MASK)) == 0, i))) for name in texts})
    df = df.withColumns({f"_{name}": F.unhex(F.array_join(F.transform(f"_{name}", _tuple_hash(F.col(name), take)), "")) for name in texts})
    return df.withColumns({name: F.col(f"_{name}") for name in texts}).drop(*[f"_{name}" for name in texts])


def likeness(a: Column, b: Column, sketches: int = 64) -> Column:
    """Share of the sketches in which two fingerprints of equal parameters agree; null if one is null."""
    a, b = F.hex(a), F.hex(b)
    same = F.filter(F.sequence(F.lit(0), F.lit(sketches - 1)), lambda j: a.substr(j * DIGITS + 1, F.lit(DIGITS)) == b.substr(j * DIGITS + 1, F.lit(DIGITS)))
    return F.when(a.isNotNull() & b.isNotNull(), F.size(same) / F.lit(sketches))


def successors(ids: DataFrame, id_col: str) -> DataFrame:
    """(id_col, next_id): the next larger id of every id, the smallest after the largest. No partition holds more than its range."""
    parts = written(ids.where(F.col(id_col).isNotNull()).select(id_col).distinct().repartitionByRange(id_col).select(id_col, F.spark_partition_id().alias("part")), "ids")
    # A row for each range partition.
    firsts = parts.groupBy("part").agg(F.min(id_col).alias("first"))
    whole = Window.orderBy("part")
    after = firsts.select("part", F.coalesce(F.lead("first").over(whole), F.min("first").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    inside = parts.withColumn("next_id", F.lead(id_col).over(Window.partitionBy("part").orderBy(id_col)))
    return inside.join(F.broadcast(after), "part").select(id_col, F.coalesce("next_id", "after").alias("next_id"))


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, take: int = 2, sketches: int = 64) -> DataFrame:
    """(id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row of docs.

    The edited text has its last half replaced by as many code points from the beginning of the next document.
    """
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    half = F.floor(F.length("text") / 2)
    longest = base.where("id is not null").groupBy("id").agg(F.max(half).alias("half"))
    links = written(successors(base, "id").join(longest, "id").select(F.col("next_id").alias("id"), F.col("id").alias("before"), "half"), "next-ids")
    # What each document hands to the one before it: no more of its text than that one can take.
    # Both joins read the same exchange of (id, text): rows without id stand aside so that neither plan has a filter of its own.
    known = base.where("id is not null")
    heads = known.join(links, "id").select("before", F.xxhash64("text").alias("by"), F.substring("text", F.lit(1), F.col("half")).alias("head"))
    heads = heads.groupBy("before").agg(F.min(F.struct("by", "head"))["head"].alias("head"))
    both = known.join(heads, known["id"] == heads["before"], "left").select("id", "text", "head")
    both = both.unionByName(base.where("id is null").select("id", "text", F.lit(None).cast("string").alias("head")))
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.coalesce(F.substring("head", F.lit(1), half), F.lit("")))
    both = both.select("id", F.length("text").cast("long").alias("n_chars"), F.xxhash64("text").alias("by"), "text", edited.alias("edited"))
    both = both.withColumn("sha", F.unhex(F.sha2("edited", 256)))
    done = written(sketched(both, {"print": "text", "edited_print": "edited"}, k, take, sketches), "prints")
    after = done.select("id", "by", "print").join(links.select("id", "before"), "id")
    after = after.groupBy("before").agg(F.min(F.struct("by", "print"))["print"].alias("after"))
    out = done.join(after, done["id"] == after["before"], "left")
    return out.select(
        F.col("id").alias(id_col), "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), F.lower(F.hex("print")).alias("fingerprint"), F.lower(F.hex("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print"), sketches).alias("near_edited"), F.coalesce(likeness(F.col("print"), F.col("after"), sketches), F.lit(0.0)).alias("near_next"),
    )
