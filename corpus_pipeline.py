"""From raw documents to packed training data: five stages, each over all that the one before kept.

Counted as part of the subpackage leasegrid.llm. Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents.

Defined results: null texts and texts without letters have no language and go; a null lang, source or label takes no part in
learning; a document without doc_id is judged by its text, is in no group of near copies and stays; rows that repeat a doc_id are judged one by one,
but go together where their id is not the smallest of its group; long texts are read whole; columns other than those of documents
are dropped, whatever their names; an empty table gives no rows, and without labels every document counts as good.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leasegrid.llm import language_id, line_dedup, ngram_join, packing, quality
from leasegrid.llm.queries import CAPACITY, QUALITY_LEAST
from leasegrid.llm.shared import discard, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document goes if its language can't be told, or if less than this share of its letters is in one language.
LANGUAGE_LEAST = 0.5
#: SQL can't express the classifiers or best-fit packing; tests/llm holds run() against brute force.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = language_id.identify(docs, language_id.fit(docs), carry=("text", "lang", "source", "n_chars"))
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LANGUAGE_LEAST)).select(*COLUMNS)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = quality.score(docs, quality.fit(docs, labels), carry=("text", "lang", "source", "n_chars"))
    return found.where(F.col("score") >= QUALITY_LEAST).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs), carry=("lang", "source"))
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def join_ngrams(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group stays. Rows without an id link with nothing and stay."""
    found = ngram_join.jaccard_components(docs).where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(found.hint("shuffle_hash"), docs["doc_id"] == found["_gone"], "left_anti").select(*COLUMNS)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, CAPACITY)


STAGES = [
    ("language ID", identify_language),
    ("quality classifier", classify_quality),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", join_ngrams),
    ("best-fit packing", pack_bins),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
