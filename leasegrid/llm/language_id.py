"""Language identification: script ranges narrow the candidates, then Viterbi over per-word scores labels spans.

Model: log probabilities of letter trigrams (hashed) for each language, and the languages that each script's letters occur in.
The script of a word's first letter narrows the candidates: only languages that use it are scored, all others are shut out
(BARRED is more than any text's words and switches come to). A script that no language was seen with leaves all of them.
A word's score for a candidate is the sum over its trigrams; words without letters favour none. Changing language between two words costs `switch`. A text where no language beats the best single one by more than half of
`switch` on any run of words needs no trellis: a path with m runs off the best language pays for m - 1 changes at least, which
from m = 2 on is half of `switch` a run or more, and a single run that covers the whole text gains nothing; so the constant path
is optimal.

The fit reads a bounded sample of labelled texts (`sample` rows, a parameter); prediction reads whole texts only.

Defined results: null texts and texts without letters are `und` with score 0, and so is every text if nothing was learned; ties
go to the language that sorts first; texts may hold any character, NUL too, and be of any length; rows may repeat; only the named columns
are read, and a carried column may not have the name of a column that is made.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leasegrid.llm.shared import carried, code_points, slices

BINS = 1 << 15
BARRED = 1e12
#: Most cells (words x languages, padded) of one trellis of several texts.
CELLS = 1 << 22
#: Letters by script; the ranges of the Unicode blocks (fixed values).
SCRIPTS = [
    ("Latin", [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)]),
    ("Greek", [(0x370, 0x3FF), (0x1F00, 0x1FFF)]),
    ("Cyrillic", [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)]),
    ("Armenian", [(0x530, 0x58F)]),
    ("Hebrew", [(0x590, 0x5FF)]),
    ("Arabic", [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)]),
    ("Indic", [(0x900, 0xDFF)]),
    ("Thai", [(0xE00, 0xE7F)]),
    ("Georgian", [(0x10A0, 0x10FF)]),
    ("Hangul", [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)]),
    ("Kana", [(0x3040, 0x30FF), (0x31F0, 0x31FF)]),
    ("Han", [(0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF)]),
]
OTHER = len(SCRIPTS)
_tables: list = []


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point of the first plane, whether it is a letter, and its script; beyond, all are letters of no script."""
    if not _tables:
        letter = np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x10000)), bool, 0x10000)
        script = np.full(0x10000, OTHER, dtype=np.int8)
        for k, (_, ranges) in enumerate(SCRIPTS):
            for a, b in ranges:
                script[a : b + 1] = k
        _tables.extend((letter, script))
    return _tables[0], _tables[1]


def flat_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, index of each word of all texts, ends: words of text i are ends[i]:ends[i + 1])."""
    words = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
    coded = pc.dictionary_encode(pc.list_flatten(words))
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))]).astype(np.int64)
    return coded.dictionary, coded.indices.to_numpy(), ends


def trigrams(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of lower-cased words: (word of each trigram, its bin, letters of each word, script of each word's first letter)."""
    letter, script = _letters()
    code, of, _, _ = code_points(pc.utf8_lower(words))
    near = np.minimum(code, 0xFFFF)
    is_letter = np.where(code < 0x10000, letter[near], [unicodedata.category(chr(c))[0] == "L" for c in code.tolist()] if (code >= 0x10000).any() else False)
    mid = np.flatnonzero(is_letter)
    # Neighbours that are no letters, or belong to another word, are 0.
    c = np.concatenate([[0], np.where(is_letter, code, 0), [0]])
    word = np.concatenate([[-1], of, [-1]])
    at = mid + 1
    left, right = c[at - 1] * (word[at - 1] == word[at]), c[at + 1] * (word[at + 1] == word[at])
    bins = ((left * 1_000_003 + c[at]) * 998_244_353 + right) * 11_400_714_819_323_198 >> 20
    n = len(words)
    count = np.bincount(of[mid], minlength=n)[:n]
    first = np.full(n, OTHER, dtype=np.int8)
    first[of[mid][::-1]] = np.where(code[mid] < 0x10000, script[near[mid]], OTHER)[::-1]
    return of[mid], bins & (BINS - 1), count, first


@dataclass
class LanguageModel:
    """langs in order; logp[bin, lang]; allowed[script, lang]."""

    langs: list[str]
    logp: np.ndarray
    allowed: np.ndarray
    switch: float = 12.0

    def word_scores(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        of, bins, count, script = trigrams(words)
        n = len(words)
        scores = np.zeros((n, len(self.langs)))
        may = self.allowed[script] | (count == 0)[:, None]
        for k in range(len(self.langs)):
            if may[:, k].all():
                scores[:, k] = np.bincount(of, weights=self.logp[bins, k], minlength=n)[:n]
            elif may[:, k].any():
                use = may[of, k]
                scores[:, k] = np.bincount(of[use], weights=self.logp[bins[use], k], minlength=n)[:n]
        scores[~may] = -BARRED
        return scores, count

    def paths(self, scores: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The label of every word on its text's best path."""
        label = np.empty(len(scores), dtype=np.int16)
        hard = []
        for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
            if a == b:
                continue
            s = scores[a:b]
            best = int(s.sum(axis=0).argmax())
            # The cut keeps the sums' precision; a lower step could only make a run look worse.
            gain = np.cumsum(np.maximum(s - s[:, best : best + 1], -1e6), axis=0)
            rise = (gain - np.minimum(np.minimum.accumulate(gain, axis=0), 0.0)).max() if len(s) > 1 else 0.0
            if len(self.langs) == 1 or max(rise, gain[0].max()) <= self.switch / 2:
                label[a:b] = best
            else:
                hard.append(i)
        # Longest first: a group is as many cells as its first text has words, times its texts.
        hard.sort(key=lambda i: ends[i] - ends[i + 1])
        at = 0
        while at < len(hard):
            most = int(max(1, min(64, CELLS // ((ends[hard[at] + 1] - ends[hard[at]]) * len(self.langs)))))
            self._trellis(scores, ends, hard[at : at + most], label)
            at += most
        return label

    def _trellis(self, scores, ends, group, label) -> None:
        """Viterbi over texts of like length side by side."""
        sizes = np.array([ends[i + 1] - ends[i] for i in group])
        steps, k = int(sizes.max()), len(self.langs)
        rows = np.zeros((steps, len(group), k))
        for g, i in enumerate(group):
            rows[: sizes[g], g] = scores[ends[i] : ends[i + 1]]
        value, back = rows[0].copy(), np.zeros((steps, len(group), k), dtype=np.int16)
        own = np.arange(k, dtype=np.int16)
        for t in range(1, steps):
            top = value.argmax(axis=1)
            jump = value[np.arange(len(group)), top][:, None] - self.switch
            stay = value >= jump
            back[t] = np.where(stay, own, top[:, None])
            value = np.where(stay, value, jump) + rows[t]
        at = value.argmax(axis=1)
        for t in range(steps - 1, -1, -1):
            for g in np.flatnonzero(sizes > t) if t >= sizes.min() else range(len(group)):
                label[ends[group[g]] + t] = at[g]
            at = back[t][np.arange(len(group)), at] if t else at


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = 4000, switch: float = 12.0) -> LanguageModel:
    """Learns from at most `sample` distinct pairs of text and lang, chosen by a hash of both; counts are made on the executors."""
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.withColumn("h", F.xxhash64("text", "lang"))
    # Only hashes are sorted; the texts of the chosen rows are read by a filter, and stay where they are but for copies.
    most = rows.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    rows = rows.where(F.col("h") <= F.lit(most)).dropDuplicates(["h"]).select("text", "lang")

    def counted(batches):
        for batch in batches:
            for part in slices(batch, 0):
                langs = part.column(1).to_pylist()
                for lang in sorted(set(langs)):
                    words, code, _ = flat_words(part.column(0).filter(pa.array([x == lang for x in langs])))
                    times = np.bincount(code, minlength=len(words))
                    of, bins, count, script = trigrams(words)
                    seen = np.bincount(bins, weights=times[of], minlength=BINS)
                    use = np.flatnonzero(seen)
                    by = np.bincount(script, weights=times * count, minlength=OTHER + 1)
                    key = np.concatenate([use, BINS + np.arange(OTHER + 1)])
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key)), pa.array(key), pa.array(np.concatenate([seen[use], by]).astype(np.int64))], names=["lang", "bin", "n"])

    # At most (BINS + scripts) rows a language come back.
    got = rows.mapInArrow(counted, "lang string, bin long, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(got["lang"].unique())
    n = np.zeros((BINS + OTHER + 1, max(1, len(langs))))
    for k, lang in enumerate(langs):
        own = got[got["lang"] == lang]
        n[own["bin"].to_numpy(), k] = own["n"].to_numpy()
    grams, by = n[:BINS], n[BINS:]
    logp = np.log(grams + 0.5) - np.log(grams.sum(axis=0) + 0.5 * BINS)
    allowed = by >= np.maximum(1, 0.001 * by.sum(axis=0))
    # Letters of a script that no language was seen with tell nothing.
    allowed[~allowed.any(axis=1)] = True
    return LanguageModel(langs, logp, allowed, switch)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id_col, lang_pred, score, spans, and the columns in carry) for each row; spans are runs of words with one label, words numbered from 0.

    lang_pred has most letters on the best path; score is its share of all letters.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            for part in slices(batch, 1, 6 << 20):
                words, code, ends = flat_words(part.column(1))
                langs, shares, spans = [], [], []
                if model.langs and len(words):
                    each, letters = model.word_scores(words)
                    label, mass = model.paths(each[code], ends), letters[code]
                for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                    total = int(mass[a:b].sum()) if model.langs and b > a else 0
                    if not total:
                        langs.append("und")
                        shares.append(0.0)
                        spans.append([])
                        continue
                    own = np.bincount(label[a:b], weights=mass[a:b], minlength=len(model.langs))
                    best = int(own.argmax())
                    langs.append(model.langs[best])
                    shares.append(float(own[best] / total))
                    cut = [0, *(np.flatnonzero(label[a + 1 : b] != label[a : b - 1]) + 1).tolist(), b - a]
                    spans.append([{"first": i, "last": j - 1, "lang": model.langs[label[a + i]]} for i, j in zip(cut[:-1], cut[1:], strict=True)])
                kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("lang", pa.string())]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs, pa.string()), pa.array(shares, pa.float64()), pa.array(spans, kind), *part.columns[2:]], names=[id_col, "lang_pred", "score", "spans", *carry])

    kind = docs.schema[id_col].dataType.simpleString()
    more = carried(docs, carry, (id_col, "lang_pred", "score", "spans"))
    # Names may repeat here: `run` reads by position.
    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"), *carry).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double, spans array<struct<first:int,last:int,lang:string>>{more}")
