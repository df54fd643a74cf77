"""Sources and sinks of runs: CSV with a BOM, JSON, JSON lines, text, sitemaps, run partitions; append, overwrite, upsert."""

from __future__ import annotations

import datetime
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leasegrid.functions.values import first_clean

RUN = re.compile(r"^\d{4}-\d{2}-\d{2}$")


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of whatever store the path is on; none if it isn't there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; a byte order mark before the first name is dropped. A missing file raises."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def read_seed(spark: SparkSession, path: str, ids: tuple[str, ...] = ("Unique ID", "Property ID", "apartmentid"), urls: tuple[str, ...] = ("Website", "website")) -> DataFrame:
    """(property_id, url): the first id column with a value, and the first url column with one, else ''."""
    df = read_csv(spark, path)
    pick = lambda cs: [F.col(f"`{c}`") for c in cs if c in df.columns] or [F.lit(None).cast("string")]
    return df.select(first_clean(*pick(ids)).alias("property_id"), F.coalesce(first_clean(*pick(urls)), F.lit("")).alias("url"))


def read_json_array(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Records of a JSON array; a missing or broken file gives an empty table."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path, multiLine=True, mode="DROPMALFORMED")


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Lines that parse; others are skipped."""
    return spark.read.schema(schema).json(path, mode="DROPMALFORMED") if exists(spark, path) else spark.createDataFrame([], schema)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def runs(spark: SparkSession, root: str) -> list[str]:
    """Run dates below root, newest first; other names are ignored."""
    return sorted((n for n in (x.removeprefix("run_date=") for x in names(spark, root)) if RUN.match(n)), reverse=True)


def read_run(spark: SparkSession, root: str, run_date: str | None = None) -> DataFrame:
    """One run of a table partitioned by run_date, the latest by default; only that partition is read."""
    date = run_date or next(iter(runs(spark, root)), None)
    if date is None:
        raise FileNotFoundError(f"no runs in {root}")
    return spark.read.parquet(root).where(F.col("run_date") == F.lit(date).cast("date"))


def read_sitemap(spark: SparkSession, path: str) -> DataFrame:
    """(loc, lastmod, priority) of a sitemap; an index document has no entries."""
    text = read_text(spark, path)
    entry = F.explode(F.regexp_extract_all("value", F.lit(r"(?s)<url>(.*?)</url>"), F.lit(1))).alias("e")
    one = lambda tag: F.nullif(F.trim(F.regexp_extract("e", rf"(?s)<{tag}>(.*?)</{tag}>", 1)), F.lit(""))
    return text.select(entry).select(one("loc").alias("loc"), one("lastmod").alias("lastmod"), one("priority").try_cast("double").alias("priority"))


def write_run(df: DataFrame, root: str, run_date: str) -> None:
    """Replaces one run's partition and leaves the others."""
    df.withColumn("run_date", F.lit(run_date).cast("date")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(root)


def append_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Quoted, with doubled quotes; null is empty."""
    df.write.mode("overwrite").csv(path, header=True, quoteAll=True, escape='"', nullValue="", emptyValue="")


def upsert_frontier(state: DataFrame, new: DataFrame) -> DataFrame:
    """New state of (url, first_seen, depth, source): the smaller depth and the first sighting stay."""
    a = state.select("url", *[F.col(c).alias(f"_{c}") for c in ("first_seen", "depth", "source")])
    return a.join(new, "url", "full").select("url", F.coalesce("_first_seen", "first_seen").alias("first_seen"), F.least("_depth", "depth").alias("depth"), F.coalesce("source", "_source").alias("source"))


def keep_recent(df: DataFrame, date_col: str, as_of: str, days: int = 30) -> DataFrame:
    """Rows whose date is not before as_of - days; unreadable dates stay."""
    date = F.try_to_date(F.col(date_col).cast("string"))
    return df.where(date.isNull() | (date >= F.date_sub(F.lit(as_of).cast("date"), days)))


def drop_old(spark: SparkSession, root: str, as_of: str, days: int = 30) -> list[str]:
    """Deletes what lies in root and is named for a date before as_of - days, unread; returns those names.

    Names are dates (2026-01-31), dates with an ending (.html, .png), or partitions (run_date=2026-01-31); all others stay.
    """
    least = datetime.date.fromisoformat(as_of) - datetime.timedelta(days=days)
    gone = []
    for name in names(spark, root):
        try:
            date = datetime.date.fromisoformat(name.partition("=")[2] or name.partition(".")[0])
        except ValueError:
            continue
        if date < least:
            at = spark._jvm.org.apache.hadoop.fs.Path(root, name)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
            gone.append(name)
    return gone
