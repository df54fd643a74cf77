"""Texts that contain patterns, both of them tables: saved URL patterns and block lists.

Patterns of proven small size go to every task as one automaton. More of them are joined by an inverted index: each pattern is filed
under the one of its grams that the fewest texts have, a text looks up its own grams, and what meets is checked. Both give the same pairs.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters of a gram, and the most bytes of patterns that are sent to every task.
GRAM, AUTOMATON_BYTES = 6, 8 << 20


def containing(texts: DataFrame, patterns: DataFrame, automaton_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """Distinct (text, pattern) with the pattern inside the text, of texts (text) and patterns (pattern). Empty and null ones meet nothing."""
    texts = texts.where("text <> ''").select("text").distinct()
    patterns = patterns.where("pattern <> ''").select("pattern").distinct()
    size = patterns.agg(F.coalesce(F.sum(F.octet_length("pattern") + 64), F.lit(0))).first()[0]
    return _by_automaton(texts, patterns) if size <= automaton_bytes else _by_grams(texts, patterns)


def _by_automaton(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    known = [r[0] for r in patterns.collect()]
    if not known:
        return texts.limit(0).select("text", F.lit("").alias("pattern"))
    sent = texts.sparkSession.sparkContext.broadcast(known)

    def scan(batches):
        import ahocorasick

        machine = ahocorasick.Automaton()
        for p in sent.value:
            machine.add_word(p, p)
        machine.make_automaton()
        for batch in batches:
            ids, found = [], []
            for i, text in enumerate(batch.column(0).to_pylist()):
                mine = dict.fromkeys(p for _, p in machine.iter(text))
                ids += [i] * len(mine)
                found += mine
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int64())), pa.array(found, pa.string())], names=["text", "pattern"])

    return texts.mapInArrow(scan, "text string, pattern string")


def _grams(text: Column, n: int) -> Column:
    return F.when(F.length(text) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substring(text, i, F.lit(n)))))


def _by_grams(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """Patterns shorter than a gram are grams of their own length; there are fewer lengths than letters in a gram."""
    lengths = sorted(r[0] for r in patterns.select(F.least(F.length("pattern"), F.lit(GRAM)).alias("n")).distinct().collect())
    short = F.least(F.length("pattern"), F.lit(GRAM))
    of = patterns.select("pattern", F.explode(F.coalesce(*[F.when(short == n, _grams(F.col("pattern"), n)) for n in lengths])).alias("gram"))
    wanted = of.select("gram").distinct()
    seen = texts.select("text", F.explode(F.array_distinct(F.flatten(F.array_compact(F.array(*[_grams(F.col("text"), n) for n in lengths]))))).alias("gram"))
    met = seen.join(wanted.hint("shuffle_hash"), "gram")
    often = met.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    # A gram that no text has rules its pattern out.
    filed = of.join(often, "gram", "left").groupBy("pattern").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("best"))
    filed = filed.where("best.n > 0").select("pattern", F.col("best.gram").alias("gram"))
    return seen.join(filed, "gram").where(F.contains("text", "pattern")).select("text", "pattern")


def first_match(texts: DataFrame, patterns: DataFrame, both_ways: bool = False, automaton_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """texts with the pattern of the lowest `place` that the text contains, or, both ways, that contains the text; null if none does.

    texts: a column text and any others but pattern and place; patterns: (pattern, place), of equal places the least pattern.
    """
    places = patterns.where("pattern <> ''").groupBy("pattern").agg(F.min("place").alias("place"))
    pairs = containing(texts, places, automaton_bytes)
    if both_ways:
        inside = containing(places.select(F.col("pattern").alias("text")), texts.select(F.col("text").alias("pattern")), automaton_bytes)
        pairs = pairs.unionByName(inside.select(F.col("pattern").alias("text"), F.col("text").alias("pattern"))).distinct()
    best = pairs.join(places, "pattern").groupBy("text").agg(F.min(F.struct("place", "pattern")).alias("_best"))
    return texts.join(best, "text", "left").withColumns({"pattern": F.col("_best.pattern"), "place": F.col("_best.place")}).drop("_best")


def unblocked(texts: DataFrame, blocked: DataFrame, substrings: bool, automaton_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """texts without those that are a pattern of blocked (pattern) or, with substrings, contain one. Null texts stay."""
    if not substrings:
        return texts.join(blocked.where("pattern <> ''").select(F.col("pattern").alias("text")).distinct(), "text", "left_anti").select(*texts.columns)
    hit = containing(texts, blocked, automaton_bytes).select("text").distinct()
    return texts.join(hit, "text", "left_anti").select(*texts.columns)
