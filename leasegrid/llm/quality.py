"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

A text is a bag of two blocks of features: words themselves (hashed; those in `common` texts of the sample at least), and what
doesn't depend on the language: each word's case pattern, length and marks, repetition of a recent word, runs of words of one
shape. Counts are damped, weighted by inverse document frequency and projected on the leading singular directions of a bounded
labelled sample. The labelled vectors are broadcast (at most `sample` rows of `rank` numbers). Every text is compared with
all of them by cosine, in blocks; the `k` nearest vote with weight similarity ** POWER.

Products are made in double precision and rounded before they are ranked, so a text's score doesn't depend on its block; of
equal products the row that sorts first (by id, then by features) is nearer.

Defined results: null and empty texts get the vote of the empty text's neighbours, and every text gets 1.0 if nothing was learned;
scores are from 0 to 1; texts may hold any character, NUL too, and be of any length; rows may repeat; only the named columns are
read, and a carried column may not have the name of a column that is made. Of conflicting labels of one id the smallest holds.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leasegrid.llm.language_id import flat_words
from leasegrid.llm.shared import carried, code_points, slices

SHAPES = 2048
#: Shapes of words first, then words.
DIMS = 2 * SHAPES
POWER = 8.0
#: What is taken off both ends of a word before it counts as itself.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~“”„‘’«»…–—¿¡"
_class: list = []


def _classes() -> np.ndarray:
    """1 lower, 2 upper, 3 digit, 4 other letter; marks from 5 on by their code."""
    if not _class:
        out = np.empty(0x10000, dtype=np.int64)
        for c in range(0x10000):
            x = chr(c)
            out[c] = 1 if x.islower() else 2 if x.isupper() else 3 if x.isdigit() else 4 if x.isalpha() else 5 + c % 27
        _class.append(out)
    return _class[0]


def word_features(words: pa.Array) -> np.ndarray:
    """One feature in 0..SHAPES/2 for each distinct word: case pattern x length x number and kind of marks."""
    code, _, start, end = code_points(words)
    kind = np.append(np.where(code < 0x10000, _classes()[np.minimum(code, 0xFFFF)], 31), 0)
    upto = lambda what: np.concatenate([[0], np.cumsum(what[:-1])])
    counts = [c[end] - c[start] for c in map(upto, (kind == 1, kind == 2, kind == 3, kind >= 5))]
    lower, upper, digit, marks = counts
    size = end - start
    first_up = (kind[start] == 2).astype(np.int64)
    case = np.where(lower + upper == 0, 0, np.where(upper == 0, 1, np.where(lower == 0, np.where(upper > 1, 2, 3), np.where(first_up & (upper == 1), 3, 4))))
    last = np.where(size > 0, kind[np.maximum(end - 1, 0)], 0)
    key = ((case * 4 + np.minimum(3, marks)) * 40 + np.where(last >= 5, last, 0)) * 3 + np.where(size > 20, 2, np.where(size > 12, 1, 0))
    key = key * 2 + (digit > 0)
    return (key * 2_654_435_761 >> 7) % (SHAPES // 2)


def word_keys(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each distinct word, lower-cased and without marks around it; 0 for words of marks only."""
    bare = pc.utf8_trim(pc.utf8_lower(words), characters=MARKS).to_pylist()
    return np.fromiter((int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True) if w else 0 for w in bare), np.int64, len(bare))


def bags(texts: pa.Array, vocabulary: np.ndarray) -> np.ndarray:
    """Dense feature counts, one row a text; vocabulary: sorted keys of the words that count as themselves."""
    words, code, ends = flat_words(texts)
    n = len(texts)
    out = np.zeros((n, DIMS), dtype=np.float32)
    if len(words):
        own = word_features(words)
        doc = np.repeat(np.arange(n), np.diff(ends))
        out += np.bincount(doc * DIMS + own[code], minlength=n * DIMS).reshape(n, DIMS)
        if len(vocabulary):
            keys = word_keys(words)
            known = (vocabulary[np.minimum(np.searchsorted(vocabulary, keys), len(vocabulary) - 1)] == keys)[code]
            out += np.bincount(doc[known] * DIMS + SHAPES + keys[code][known] % (DIMS - SHAPES), minlength=n * DIMS).reshape(n, DIMS)
        head = SHAPES // 2
        # Repeats: of the word before, and of one of the three before that; in the same text only.
        again, near = np.zeros(len(code), bool), np.zeros(len(code), bool)
        for back in (1, 2, 3, 4):
            same = np.zeros(len(code), bool)
            same[back:] = (code[back:] == code[:-back]) & (doc[back:] == doc[:-back])
            again, near = (same, near) if back == 1 else (again, near | same)
        for k, flag in enumerate((again, near & ~again, ~again & ~near)):
            out[:, head + k] = np.bincount(doc[flag], minlength=n)
        # Runs: a feature next to the same feature tells lists and tables from prose.
        alike = np.zeros(len(code), bool)
        alike[1:] = (own[code][1:] == own[code][:-1]) & (doc[1:] == doc[:-1])
        out += np.bincount((doc * DIMS + head + 8 + own[code] % (head - 16))[alike], minlength=n * DIMS).reshape(n, DIMS)
    return out


@dataclass
class QualityModel:
    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    k: int
    vocabulary: np.ndarray

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return _unit(_weighted(counts, self.idf) @ self.basis)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Cosine products of a block with all labelled vectors, then the vote of the k nearest (ties: earlier rows)."""
        if not len(self.labels):
            return np.ones(len(counts))
        like = (self.latent(counts) @ self.vectors.T).round(9)
        k = min(self.k, like.shape[1])
        least = -np.partition(-like, k - 1, axis=1)[:, k - 1 : k]
        use = like >= least
        for i in np.flatnonzero(use.sum(axis=1) > k):
            tied = np.flatnonzero(like[i] == least[i])
            use[i, tied[k - int((like[i] > least[i]).sum()) :]] = False
        near = np.nonzero(use)[1].reshape(-1, k)
        weight = np.maximum(np.take_along_axis(like, near, axis=1), 1e-3) ** POWER
        return (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    total = np.maximum(counts[:, : SHAPES // 2].sum(axis=1, keepdims=True), 1)
    return _unit(np.sqrt(counts.astype(np.float64) / total) * idf)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = 4096, rank: int = 48, k: int = 15, common: int = 8) -> QualityModel:
    """Learns from at most `sample` labelled rows, half of each label if there are as many, chosen by a hash of the id."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).cast("int").alias("_y"))
    picked = [known.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(sample // 2) for y in (0, 1)]
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).join(F.broadcast(picked[0].union(picked[1])), "_id")

    def terms(batches):
        for batch in batches:
            for part in slices(batch, 1, 2 << 20, 512):
                words, code, ends = flat_words(part.column(1))
                keys = word_keys(words)[code]
                of = np.repeat(np.arange(part.num_rows), np.diff(ends))
                each = np.unique(np.stack([of, keys], axis=1), axis=0)[:, 1]
                key, n = np.unique(each[each != 0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], names=["key", "n"])

    # Words in few texts stay on the executors: at most the sample's words / common come back.
    often = rows.mapInArrow(terms, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= common).select("key").toPandas()
    vocabulary = np.sort(often["key"].to_numpy(dtype=np.int64))

    def counted(batches):
        for batch in batches:
            for part in slices(batch, 1, 2 << 20, 512):
                counts = bags(part.column(1), vocabulary)
                use = [np.flatnonzero(c) for c in counts]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([u.astype(np.int32).tobytes() for u in use], pa.binary()), pa.array([c[u].tobytes() for c, u in zip(counts, use, strict=True)], pa.binary())], names=["id", "y", "at", "n"])

    # Bounded by `sample` rows (more only if an id repeats), each at most DIMS numbers.
    got = rows.mapInArrow(counted, f"id {docs.schema[id_col].dataType.simpleString()}, y int, at binary, n binary").orderBy("id", "at", "n").limit(2 * sample).toPandas()
    counts = np.zeros((len(got), DIMS), dtype=np.float32)
    for i, (at, n) in enumerate(zip(got["at"], got["n"], strict=True)):
        counts[i, np.frombuffer(at, np.int32)] = np.frombuffer(n, np.float32)
    y = got["y"].to_numpy(dtype=np.float64)
    idf = 1 + np.log((1 + len(got)) / (1 + (counts > 0).sum(axis=0)))
    del got
    # The driver holds the sample once, in single precision, and weighs it in place.
    x = counts
    for i in range(0, len(x), 256):
        x[i : i + 256] = _weighted(x[i : i + 256], idf)
    # Leading singular directions by subspace iteration.
    rng = np.random.default_rng(7)
    basis = np.linalg.qr(rng.standard_normal((DIMS, rank)).astype(np.float32))[0]
    for _ in range(8 if len(x) else 0):
        basis = np.linalg.qr(x.T @ (x @ basis))[0]
    basis = basis.astype(np.float64)
    vectors = np.zeros((len(x), rank))
    for i in range(0, len(x), 256):
        vectors[i : i + 256] = _unit(x[i : i + 256].astype(np.float64) @ basis)
    return QualityModel(idf, basis, vectors, y, k, vocabulary)


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id_col, score, and the columns in carry) for each row: from 0 to 1, higher where label 1 is likelier."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            for part in slices(batch, 1, 2 << 20, 512):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.clip(model.scores(bags(part.column(1), model.vocabulary)), 0, 1).astype(np.float64)), *part.columns[2:]], names=[id_col, "score", *carry])

    kind = docs.schema[id_col].dataType.simpleString()
    more = carried(docs, carry, (id_col, "score"))
    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"), *carry).mapInArrow(run, f"`{id_col}` {kind}, score double{more}")
