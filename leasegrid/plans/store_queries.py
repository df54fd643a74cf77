"""Pattern tables, bounded rolling windows, versioned documents, delivered events, bound requests and change detection."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from leasegrid.operators import patterns, requests, rolling
from leasegrid.plans.tables import PROPERTIES, properties, table
from leasegrid.sources.documents import DocumentStore
from leasegrid.streaming import probes, sink

ALL: dict = {}


def query(name: str, sql: str | None = None):
    return lambda f: ALL.setdefault(name, (f, sql)) and f


def place(spark, name: str) -> str:
    """A new folder that the driver and all executors share; local sessions without spark.checkpoint.dir get a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="leasegrid-")
    return f"{root.rstrip('/')}/leasegrid-stores/{name}-{uuid.uuid4().hex}"


# Patterns ---------------------------------------------------------------------------------------------------------
#: A page's address as it was saved for its site: language and the first two digits of its number.
SAVED = r"://[^/]+(/[a-z]+/[0-9]{1,2})"
ADDRESS = r"://[^/]+(/[^?#]*)"


def _saved(spark, d):
    p = table(spark, d, "pages").select(F.regexp_extract("url", SAVED, 1).alias("pattern"), F.col("page_id").alias("place"))
    return p.where("pattern <> ''")


@query("q_j12_mappings", f"""WITH p AS (SELECT regexp_extract(url, '{SAVED}', 1) AS pattern, min(page_id) AS place FROM pages GROUP BY 1)
SELECT page_id, arg_min(pattern, (place, pattern)) AS pattern, min(place) AS place FROM pages LEFT JOIN p ON pattern <> '' AND contains(url, pattern) GROUP BY 1""")
def mappings(spark, d):
    """The saved pattern of the lowest place inside each page's address."""
    pages = table(spark, d, "pages").select("page_id", F.col("url").alias("text"))
    return patterns.first_match(pages, _saved(spark, d)).select("page_id", "pattern", "place")


@query("q_j12_both_ways", f"""WITH t AS (SELECT page_id, regexp_extract(url, '{SAVED}', 1) AS text FROM pages), p AS (SELECT regexp_extract(url, '{ADDRESS}', 1) AS pattern, min(page_id) AS place FROM pages GROUP BY 1)
SELECT page_id, arg_min(pattern, (place, pattern)) AS pattern, min(place) AS place FROM t LEFT JOIN p ON pattern <> '' AND text <> '' AND (contains(text, pattern) OR contains(pattern, text)) GROUP BY 1""")
def both_ways(spark, d):
    """The same with the pattern inside the address or the address inside the pattern, by the inverted index."""
    pages = table(spark, d, "pages")
    saved = pages.select(F.regexp_extract("url", ADDRESS, 1).alias("pattern"), F.col("page_id").alias("place"))
    found = patterns.first_match(pages.select("page_id", F.regexp_extract("url", SAVED, 1).alias("text")), saved, both_ways=True, automaton_bytes=0)
    return found.select("page_id", "pattern", "place")


_BLOCKED = r"SELECT regexp_extract(url, '://([^/]+)', 1) AS pattern FROM pages WHERE contains(url, '?page=') UNION SELECT url FROM pages WHERE contains(url, '#top')"


def _blocked(spark, d):
    p = table(spark, d, "pages")
    hosts = p.where(F.contains("url", F.lit("?page="))).select(F.regexp_extract("url", "://([^/]+)", 1).alias("pattern"))
    return hosts.unionByName(p.where(F.contains("url", F.lit("#top"))).select(F.col("url").alias("pattern")))


@query("q_p24_exact", f"SELECT page_id, url FROM pages WHERE url NOT IN (SELECT pattern FROM ({_BLOCKED}))")
def exact(spark, d):
    pages = table(spark, d, "pages").select("page_id", F.col("url").alias("text"))
    return patterns.unblocked(pages, _blocked(spark, d), substrings=False).select("page_id", F.col("text").alias("url"))


@query("q_p24_substring", f"SELECT page_id, url FROM pages p WHERE NOT EXISTS (SELECT 1 FROM ({_BLOCKED}) b WHERE contains(p.url, b.pattern))")
def substring(spark, d):
    pages = table(spark, d, "pages").select("page_id", F.col("url").alias("text"))
    return patterns.unblocked(pages, _blocked(spark, d), substrings=True).select("page_id", F.col("text").alias("url"))


# Windows ----------------------------------------------------------------------------------------------------------
@query("q_w07_attempts", """WITH e AS (SELECT event_id, user_id % 5 AS domain, floor(epoch(ts))::BIGINT AS s, (event_type = 'error')::INT AS bad FROM events),
r AS (SELECT *, row_number() OVER w AS k, sum(bad) OVER w AS f, count(*) OVER (PARTITION BY domain ORDER BY s RANGE UNBOUNDED PRECEDING) - count(*) OVER (PARTITION BY domain ORDER BY s RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW) AS before
  FROM e WINDOW w AS (PARTITION BY domain ORDER BY s, event_id ROWS UNBOUNDED PRECEDING)),
n AS (SELECT r.event_id, r.domain, r.k, r.k - greatest(r.before, r.k - 2000) AS n, r.f - coalesce(b.f, 0) AS errors FROM r LEFT JOIN r b ON b.domain = r.domain AND b.k = greatest(r.before, r.k - 2000))
SELECT event_id, domain, n::BIGINT AS n, errors::BIGINT AS errors, max((errors > 0.2 * n)::INT) OVER (PARTITION BY domain ORDER BY k ROWS UNBOUNDED PRECEDING) = 1 AS forced FROM n""")
def attempts(spark, d):
    """Failures among a domain's last 2,000 attempts of its last seven days."""
    e = table(spark, d, "events").select("event_id", (F.col("user_id") % 5).alias("domain"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("s"), (F.col("event_type") == "error").alias("bad"))
    found = rolling.last_attempts(e, "domain", "s", "event_id", "bad", span=604_800, most=2000, threshold=0.2)
    return found.select("event_id", "domain", "n", "errors", "forced")


# Stores -----------------------------------------------------------------------------------------------------------
@query("q_k14_documents", """WITH s AS (SELECT user_id, event_type, max(event_id) AS event_id FROM events GROUP BY 1, 2)
SELECT user_id, arg_max(event_id, event_type) AS event_id, max(event_type) AS event_type, count(*) AS version FROM s GROUP BY 1""")
def documents(spark, d):
    """A document a user, saved once for each kind of event the user has, kind by kind; what the store then has as current."""
    e = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.max("event_id").alias("event_id"))
    store = DocumentStore(spark, place(spark, "documents"), "user_id")
    # A few kinds; each save writes its own documents only.
    for kind in sorted(r[0] for r in e.select("event_type").distinct().collect()):
        store.save(e.where(F.col("event_type") == kind))
    return store.current().select("user_id", "event_id", "event_type", "version")


@query("q_t14_delivered", "SELECT event_type, count(*) FILTER (value >= 1) AS delivered, count(*) FILTER (value < 1) AS dead FROM events GROUP BY 1")
def delivered(spark, d):
    """Events as a stream into the ledger; those whose payload is no object (small values' are broken here) end as dead letters."""
    root = place(spark, "events")
    source = table(spark, d, "events")
    stream = spark.readStream.schema(source.schema).parquet(f"{d}/events*.parquet")
    stream = stream.withColumn("props", F.when(F.col("value") < 1, F.concat(F.lit("["), "props", F.lit("]"))).otherwise(F.col("props")))
    sink.deliver(stream, root, f"{root}/checkpoint", sink.event_trouble).awaitTermination()
    n = lambda name: spark.read.parquet(f"{root}/{name}").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    both = n("events").select("event_type", F.col("n").alias("delivered")).join(n("dead").select("event_type", F.col("n").alias("dead")), "event_type", "full")
    return both.fillna(0, ["delivered", "dead"])


@query("q_p15_request", f"WITH {PROPERTIES}, k AS (SELECT * FROM props WHERE contains(lower(name), '1') AND status IN ('BUILDING', 'MACHINERY')) SELECT *, (SELECT count(*) FROM k) AS total FROM k ORDER BY city DESC NULLS LAST, id LIMIT 40 OFFSET 40")
def request(spark, d):
    return requests.property_page(properties(spark, d), {"search": "1", "status": "BUILDING,MACHINERY", "sort": "city", "dir": "desc", "page": "2", "pageSize": "40", "junk": "'; --"})


# Change detection -------------------------------------------------------------------------------------------------
def probe_rows(spark, d):
    """Events as probes: a user is a property; what its tags say changes every few events."""
    e = table(spark, d, "events")
    tag = lambda n, name: F.when(F.col("value") > n, F.concat(F.lit(name), F.floor(F.col("value") / 100).cast("string")))
    return e.select(
        F.col("user_id").alias("property_id"), F.col("ts").cast("timestamp").alias("ts"), F.when(F.col("event_type") == "view", 304).otherwise(200).alias("status"), tag(5, "e").alias("etag"),
        F.lit(None).cast("string").alias("last_modified"), F.when(F.col("event_type") == "click", tag(2, "s")).alias("sitemap_lastmod"), F.when(F.col("event_type") == "signup", tag(0, "h")).alias("api_hash"),
    )


@query("q_t10_probes")
def change_detection(spark, d):
    """Each probe's decision; what is known of a property comes from its last full scrape, so SQL can't say it without recursion."""
    return probes.decided(probe_rows(spark, d)).groupBy("property_id", "overall").agg(F.count(F.lit(1)).alias("n"), F.max("carried").alias("carried"), F.count_if("forced").alias("forced"))
