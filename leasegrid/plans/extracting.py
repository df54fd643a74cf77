"""Extraction from payload JSON and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from leasegrid.operators import html_units
from leasegrid.plans.tables import table

ALL: dict = {}


def query(name: str, sql: str | None = None):
    return lambda f: ALL.setdefault(name, (f, sql)) and f


@query("q_x01_variant_field", "SELECT event_id, json_keys(props) IS NOT NULL AS is_object, coalesce(len(json_keys(props)), 0)::INT AS n_keys FROM events")
def variant_field(spark, d):
    value = F.try_variant_get(F.try_parse_json("props"), "$", "map<string,variant>")
    return table(spark, d, "events").select("event_id", value.isNotNull().alias("is_object"), F.coalesce(F.size(value), F.lit(0)).alias("n_keys"))


@query("q_x26_payload_keys", "SELECT k AS key, count(*) AS n FROM (SELECT unnest(json_keys(props)) AS k FROM events) GROUP BY k")
def payload_keys(spark, d):
    value = F.try_variant_get(F.try_parse_json("props"), "$", "map<string,variant>")
    return table(spark, d, "events").select(F.explode(F.map_keys(value)).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


@query("q_f38_html_metrics", "SELECT page_id, octet_length(encode(html)) AS n_bytes, len(regexp_extract_all(html, '<script')) AS n_scripts, len(regexp_extract_all(html, '<a ')) AS n_links FROM pages")
def html_metrics(spark, d):
    n = lambda p: F.regexp_count("html", F.lit(p)).cast("bigint")
    return table(spark, d, "pages").select("page_id", F.octet_length("html").cast("bigint").alias("n_bytes"), n("<script").alias("n_scripts"), n("<a ").alias("n_links"))


@query("q_x32_title", "SELECT page_id, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title FROM pages")
def title(spark, d):
    return table(spark, d, "pages").select("page_id", F.nullif(F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.lit("")).alias("title"))


@query("q_o05_link_rank", """WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="(/[^"]*)"', 1)) AS href FROM pages),
s AS (SELECT DISTINCT page_id, href, CASE WHEN length(href) > 8 THEN 2 ELSE 0 END + CASE WHEN contains(lower(href), 'e') THEN 3 ELSE 0 END AS score FROM l)
SELECT page_id, href, score, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, href) AS place FROM s QUALIFY place <= 5""")
def link_rank(spark, d):
    from pyspark.sql import Window

    links = table(spark, d, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="(/[^"]*)"'), F.lit(1))).alias("href")).distinct()
    score = F.when(F.length("href") > 8, 2).otherwise(0) + F.when(F.lower("href").contains("e"), 3).otherwise(0)
    best = Window.partitionBy("page_id").orderBy(F.desc("score"), "href")
    return links.withColumn("score", score).withColumn("place", F.row_number().over(best)).where("place <= 5")


@query("q_x20_text", r"SELECT page_id, length(regexp_replace(regexp_replace(html, '<(script|style|nav|footer)[^>]*>.*?</(script|style|nav|footer)>', ' ', 'gs'), '<[^>]*>', ' ', 'g')) AS n_text FROM pages")
def page_text(spark, d):
    """Length of the visible text: scripts, styles, navigation and tags out."""
    bare = F.regexp_replace("html", r"(?s)<(script|style|nav|footer)[^>]*>.*?</(script|style|nav|footer)>", " ")
    return table(spark, d, "pages").select("page_id", F.length(F.regexp_replace(bare, "<[^>]*>", " ")).cast("bigint").alias("n_text"))


REWRITTEN = (('href="/a', 'href="/apartments/a'), ('href="/d', 'href="https://x.rentcafe.com/d'), ('href="/e', 'href="units/e'), ('">s', '">Floor <b>plan</b> s'))


def _rewritten(column: str) -> str:
    for old, new in REWRITTEN:
        column = f"replace({column}, '{old}', '{new}')"
    return column


def _weights(column: str, call: str, weights) -> str:
    return " + ".join(f"CASE WHEN {call}({column}, '{x}') THEN {n} ELSE 0 END" for x, n in weights)


@query("q_o05_ranked_links", rf"""WITH q AS (SELECT page_id, url, {_rewritten("html")} AS html FROM pages), a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\s(?:[^>]*\s)?href\s*=\s*["''][^"'']*["''][^>]*>.*?</a>')) AS tag,
  generate_subscripts(regexp_extract_all(html, '(?is)<a\s(?:[^>]*\s)?href\s*=\s*["''][^"'']*["''][^>]*>.*?</a>'), 1) AS pos FROM q),
l AS (SELECT page_id, url, pos, trim(regexp_extract(tag, '(?is)^<a\s(?:[^>]*\s)?href\s*=\s*["'']([^"'']*)["'']', 1)) AS href,
  lower(trim(regexp_replace(regexp_replace(tag, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')))[:120] AS anchor, regexp_extract(url, '^https?://[^/?#]*') AS site FROM a),
f AS (SELECT page_id, url, pos, anchor, CASE WHEN href LIKE 'http%' THEN href WHEN href LIKE '/%' THEN site || href
  ELSE site || coalesce(nullif(regexp_extract(url, '^https?://[^/?#]*([^?#]*/)', 1), ''), '/') || href END AS href, lower(regexp_extract(url, '^https?://([^/?#:]*)', 1)) AS own
  FROM l WHERE href <> '' AND NOT ({" OR ".join(f"contains(lower(href), '{x}')" for x in html_units.LINK_NEVER)})),
h AS (SELECT *, lower(regexp_extract(href, '^https?://([^/?#:]*)', 1)) AS host, lower(regexp_extract(href, '^https?://[^/?#]*([^?#]*)', 1)) AS path FROM f),
s AS (SELECT *, {_weights("anchor", "contains", html_units.LINK_TEXT)} + {_weights("path", "contains", html_units.LINK_PATH)} + {_weights("host", "ends_with", html_units.LINK_HOST)} AS score FROM h
  WHERE (host = own OR ends_with(host, '.' || own) OR ends_with(own, '.' || host) OR {" OR ".join(f"ends_with(host, '{x}')" for x, _ in html_units.LINK_HOST)}) AND rtrim(href, '/') <> rtrim(url, '/')),
b AS (SELECT page_id, href, max(score)::INT AS score, min(pos) AS pos, arg_min(anchor, (-score, pos)) AS anchor FROM s WHERE score > 0 GROUP BY 1, 2)
SELECT page_id, href, score, anchor, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, pos)::INT AS place FROM b QUALIFY place <= 5""")
def ranked_links(spark, d):
    """Some of the pages' links and texts are rewritten first, so that there are links of every kind to rank."""
    html = F.col("html")
    for old, new in REWRITTEN:
        html = F.replace(html, F.lit(old), F.lit(new))
    return html_units.ranked_links(table(spark, d, "pages").select("page_id", "url", html.alias("html")))
