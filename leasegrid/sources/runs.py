"""Runs across schema roots, seed files with free headers, reports and saved documents.

Folders are listed through Hadoop's file systems, so paths may lie on any store. Only names reach the driver, never contents.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leasegrid.sources.files import RUN, exists, names, read_csv, read_seed, read_text, runs

# Headers of property lists, lower-cased, and what they mean; spellings of the lease-up type.
HEADERS = {
    "property id": "property_id", "property_id": "property_id", "id": "property_id", "property url": "url", "url": "url", "property type": "type", "type": "type",
    "pms platform": "pms_platform", "pms_platform": "pms_platform", "zip": "zip", "state": "state", "property name": "name", "name": "name",
}
LEASE_UP = ("lease-up", "lease up", "lease_up", "leaseup")
FIELDS = ("property_id", "url", "type", "pms_platform", "zip", "state", "name")
SCHEMA_ROOTS = ("runs", "v1/runs", "v2/runs")


def read_properties(spark: SparkSession, path: str) -> DataFrame:
    """FIELDS of a property list whose headers may have any case and alias; rows without id or url go.

    Of headers with one meaning the last one counts, empty or not. Other columns are not read.
    """
    df = read_csv(spark, path)
    at = {HEADERS[name]: i for i, c in enumerate(df.columns) if (name := c.strip().lower()) in HEADERS}
    df = df.toDF(*[str(i) for i in range(len(df.columns))])
    text = {f: F.coalesce(F.trim(F.col(f"`{at[f]}`")), F.lit("")) if f in at else F.lit("") for f in FIELDS}
    kind = F.when(F.lower(text["type"]).isin(*LEASE_UP), "LEASE_UP").otherwise("STABILISED")
    some = lambda c: F.nullif(c, F.lit(""))
    rest = [some(F.lower(text["pms_platform"])).alias("pms_platform"), *[some(text[f]).alias(f) for f in ("zip", "state", "name")]]
    return df.select(text["property_id"].alias("property_id"), text["url"].alias("url"), kind.alias("type"), *rest).where("property_id <> '' AND url <> ''")


def id_urls(spark: SparkSession, path: str) -> DataFrame:
    """(property_id, url) of a seed file, one row an id; of several urls of an id the smallest."""
    return read_seed(spark, path).where("property_id IS NOT NULL AND url <> ''").groupBy("property_id").agg(F.min("url").alias("url"))


def latest_name(spark: SparkSession, root: str) -> str:
    """The last name in a folder of runs, whatever its form."""
    found = names(spark, root)
    if not found:
        raise FileNotFoundError(f"no runs in {root}")
    return found[-1]


def latest_run(spark: SparkSession, base: str) -> str | None:
    """The path of the newest dated run below any schema root; of equal dates the one of the first root."""
    found = [(n, -i, f"{base}/{root}/{n}") for i, root in enumerate(SCHEMA_ROOTS) for n in names(spark, f"{base}/{root}") if RUN.match(n)]
    return max(found)[2] if found else None


def root_of(spark: SparkSession, base: str, version: str, leaf: str) -> str:
    """base/version/leaf where it exists, else base/leaf."""
    versioned = f"{base}/{version}/{leaf}"
    return versioned if exists(spark, versioned) else f"{base}/{leaf}"


def read_roots(spark: SparkSession, base: str, leaf: str) -> DataFrame | None:
    """A Parquet table of all schema roots with their root in `_root`; columns that a root lacks are null."""
    out = None
    for root in SCHEMA_ROOTS:
        if exists(spark, path := f"{base}/{root}/{leaf}"):
            df = spark.read.parquet(path).withColumn("_root", F.lit(root))
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def sitemap_lastmod(url: Column, body: Column) -> Column:
    """lastmod of the first entry of a sitemap text whose location ends with the path of url; null without one."""
    one = lambda block, tag: F.regexp_extract(block, rf"(?i)<{tag}>(.*?)</{tag}>", 1)
    path = F.coalesce(F.nullif(F.try_parse_url(url, F.lit("PATH")), F.lit("")), F.lit("/"))
    blocks = F.regexp_extract_all(body, F.lit(r"(?is)<url>(.*?)</url>"), F.lit(1))
    own = F.filter(blocks, lambda b: (F.trim(one(b, "loc")) != "") & (F.endswith(F.trim(one(b, "loc")), path) | (F.trim(one(b, "loc")) == url)))
    return F.nullif(F.trim(one(F.get(own, F.lit(0)), "lastmod")), F.lit(""))


def read_property_reports(spark: SparkSession, run: str) -> DataFrame:
    """(property_id, tier, units, calls, cost, first_error) of every Markdown report of a run; the file's name is the id."""
    text = spark.read.text(f"{run}/property_reports/*.md", wholetext=True).select("value", "_metadata.file_name")
    got = lambda pattern: F.nullif(F.trim(F.regexp_extract("value", pattern, 1)), F.lit(""))
    row = lambda label, value: got(rf"(?i)\|\s*{label}\s*\|\s*{value}")
    return text.select(
        F.regexp_replace("file_name", r"\.md$", "").alias("property_id"), got(r"\*\*Extraction Tier:\*\*\s*`([^`]+)`").alias("tier"),
        row("Units Extracted", r"(\d+)\s*\|").try_cast("int").alias("units"), row("LLM Calls Made", r"(\d+)\s*\|").try_cast("int").alias("calls"),
        row("LLM Total Cost", r"\$?([\d.]+)").try_cast("double").alias("cost"), F.substring(got(r"(?i)## Errors\s*\n+\s*1\.\s*(.+)"), 1, 80).alias("first_error"),
    )


def newest_text(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """(run_date, value) of the newest run that has a file of this name; older runs are only looked at if it lacks."""
    for date in runs(spark, root):
        if exists(spark, path := f"{root}/{date}/{name}"):
            return read_text(spark, path).select(F.lit(date).cast("date").alias("run_date"), "value")
    return None


def first_report(spark: SparkSession, run: str) -> str | None:
    """The path of the first report*.json of a run."""
    return next((f"{run}/{n}" for n in names(spark, run) if n.startswith("report") and n.endswith(".json")), None)


def read_documents(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """One row a JSON document of a folder, its id from the file's name in `_id`; broken documents go."""
    if not [n for n in names(spark, folder) if n.endswith(".json")]:
        return spark.createDataFrame([], schema).withColumn("_id", F.lit(None).cast("string"))
    df = spark.read.schema(schema).option("pathGlobFilter", "*.json").json(folder, multiLine=True, mode="DROPMALFORMED")
    return df.select("*", F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "").alias("_id"))


def read_replay(spark: SparkSession, html_root: str, date: str) -> DataFrame:
    """(property_id, html) of all pages kept for a date as <id>.html.gz; Spark unpacks them."""
    text = spark.read.text(posixpath.join(html_root, date, "*.html.gz"), wholetext=True)
    return text.select(F.regexp_replace(F.col("_metadata.file_name"), r"\.html\.gz$", "").alias("property_id"), F.col("value").alias("html"))


def replay(pages: DataFrame, events: DataFrame) -> DataFrame:
    """Pages with what their last `extract.tier_won` event says; events: (property_id, kind, ts, data). Pages without one stay."""
    won = events.where("kind = 'extract.tier_won'").groupBy("property_id").agg(F.max_by(F.struct("ts", "data"), F.struct("ts", "data")).alias("won"))
    return pages.join(won, "property_id", "left").select("property_id", "html", F.col("won.ts").alias("won_at"), F.col("won.data").alias("won"))
