"""Decision rules, joins, checks and page rules over whole given tables, each with SQL that states the expected rows.

Where the given tables lack an input (a status, a notice), it is derived from their columns, and the SQL states the outcome of the
rule for that derivation by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from leasegrid.functions import decisions as rules
from leasegrid.functions import values as v
from leasegrid.operators import frames, html_units
from leasegrid.plans.tables import PROPERTIES, UNITS, properties, table, units
from leasegrid.sources import files

ALL: dict = {}


def query(name: str, sql: str | None = None):
    return lambda f: ALL.setdefault(name, (f, sql)) and f


def choice(c: Column, *values) -> Column:
    """values[c mod their number]; None is null."""
    out = F
    for at, x in enumerate(values):
        out = out.when(c % len(values) == at, F.lit(x))
    return out


def n_rows() -> Column:
    return F.count(F.lit(1))


# Decisions ------------------------------------------------------------------------------------------------------------
@query("q_f26_text_facts", """SELECT o_orderkey, (o_orderkey % 10000)::VARCHAR AS unit_number, floor(o_totalprice / 100) AS asking_rent, 850::BIGINT AS sqft,
CASE WHEN o_custkey % 4 = 0 THEN 'Studio' ELSE (o_custkey % 4) || '/1' END AS floor_plan_type, (o_orderkey % 9 + 1)::INT AS floor,
CASE WHEN o_orderstatus = 'P' THEN 'UNAVAILABLE' ELSE 'AVAILABLE' END AS availability_status,
CASE WHEN o_orderstatus <> 'F' THEN o_orderdate::DATE END AS availability_date, CASE WHEN o_orderkey % 5 = 0 THEN '2 months free' END AS concession_text FROM orders""")
def text_facts(spark, d):
    """Facts read back from notices written from orders."""
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    plan = F.when(F.col("o_custkey") % 4 == 0, "Studio").otherwise(F.concat((F.col("o_custkey") % 4).cast("string"), F.lit(" Bed / 1 Bath")))
    when = F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("Available "), F.date_format(day, "M/d/yyyy"))).when(F.col("o_orderstatus") == "F", "Available now").otherwise(F.concat(F.lit("Leased until "), F.date_format(day, "MMMM d, yyyy")))
    offer = F.when(k % 5 == 0, "2 months free")
    notice = F.concat_ws(" ", F.lit("Unit"), F.concat(F.lit("#"), (k % 10_000).cast("string")), plan, F.lit("850 sq ft"), F.concat(F.lit("$"), F.format_number(F.floor(F.col("o_totalprice") / 100), 0)), F.lit("Floor"), (k % 9 + 1).cast("string"), when, offer)
    return frames.with_text_facts(table(spark, d, "orders").select("o_orderkey", notice.alias("notice")), "notice", 2026).drop("notice")


@query("q_f31_classify", """WITH e AS (SELECT event_id AS i, [200, 304, 407, 429, 403, 500, 404, 302, NULL][event_id % 9 + 1] AS s, event_id % 2 = 0 AS c, event_id % 11 AS x FROM events)
SELECT i AS event_id, CASE WHEN x IN (0, 1) THEN 'TRANSIENT' WHEN s IS NULL OR s IN (500, 302) THEN 'TRANSIENT' WHEN s = 304 THEN 'NOT_MODIFIED' WHEN s = 407 THEN 'PROXY_ERROR' WHEN s = 429 THEN 'RATE_LIMITED' WHEN s = 403 AND c THEN 'BOT_BLOCKED' WHEN s = 200 THEN 'OK' ELSE 'HARD_FAIL' END AS outcome,
CASE WHEN x = 0 THEN 'timeout' WHEN x = 1 THEN 'connection_ConnectionResetError' WHEN s IS NULL THEN CASE WHEN x = 2 THEN 'ValueError' ELSE 'no_response' END WHEN s IN (200, 304) THEN NULL WHEN s = 403 AND c THEN 'CAPTCHA_RECAPTCHA' ELSE 'HTTP_' || s END AS signature FROM e""")
def classify(spark, d):
    i = F.col("event_id")
    body = F.concat(F.col("props"), F.when(i % 2 == 0, '<div class="g-recaptcha">').otherwise(""))
    error = F.when(i % 11 == 0, "TimeoutError").when(i % 11 == 1, "ConnectionResetError").when(i % 11 == 2, "ValueError")
    made = rules.classify_response(choice(i, 200, 304, 407, 429, 403, 500, 404, 302, None), body, error)
    return table(spark, d, "events").select("event_id", made.alias("r")).select("event_id", "r.*")


@query("q_p30_captcha", "SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'cloudflare' WHEN 1 THEN 'hcaptcha' WHEN 2 THEN 'perimeterx' END AS provider FROM pages")
def captcha(spark, d):
    """A mark behind the first 4096 bytes does not count."""
    mark = choice(F.col("page_id"), "Just a moment...", '<i class="h-captcha">', "PerimeterX", "")
    late = F.concat(F.repeat(F.lit("-"), 4096), F.lit("g-recaptcha"))
    return table(spark, d, "pages").select("page_id", rules.captcha(F.concat(mark, F.lit(" "), F.col("html"), late)).alias("provider"))


@query("q_f32_decide", """WITH o AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 13 < 12 THEN o_orderkey % 13 END AS days, o_custkey % 3 AS m FROM orders)
SELECT k AS o_orderkey, CASE WHEN k % 50 = 0 OR days IS NULL OR days > 7 THEN 'RENDER' WHEN m = 0 AND days < 1 OR k % 3 = 2 OR m = 1 AND days < 3 THEN 'GET' ELSE 'RENDER' END AS mode,
CASE WHEN k % 50 = 0 THEN 'manual_force' WHEN days IS NULL OR days > 7 THEN 'stale_render_7d' WHEN m = 0 AND days < 1 THEN 'hot_profile_fresh' WHEN k % 3 = 2 THEN 'sitemap_unchanged' WHEN m = 1 AND days < 3 THEN 'warm_profile_static' ELSE 'default_render' END AS reason FROM o""")
def decide(spark, d):
    k, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    made = rules.fetch_mode(k % 50 == 0, F.when(k % 13 < 12, k % 13), choice(F.col("o_custkey"), "HOT", "WARM", "COLD"), day, F.date_add(day, (k % 3 - 1).cast("int")))
    return table(spark, d, "orders").select("o_orderkey", made.alias("r")).select("o_orderkey", "r.*")


@query("q_f33_carry", """WITH e AS (SELECT event_id AS i, ['OK', 'HARD_FAIL', 'NOT_MODIFIED', 'TRANSIENT', 'RATE_LIMITED', NULL][event_id % 6 + 1] AS o, event_type AS t, value AS n FROM events), r AS (SELECT i,
CASE WHEN o IN ('HARD_FAIL', 'NOT_MODIFIED', 'TRANSIENT') THEN 'fetch_' || o WHEN t = 'signup' THEN 'no_scrape_result' WHEN t = 'error' THEN 'extraction_failed' WHEN floor(n) % 5 = 0 AND t <> 'view' THEN 'empty_units' ELSE '' END AS reason FROM e)
SELECT i AS event_id, reason <> '' AS carry, reason FROM r""")
def carry(spark, d):
    outcome = choice(F.col("event_id"), "OK", "HARD_FAIL", "NOT_MODIFIED", "TRANSIENT", "RATE_LIMITED", None)
    tier = F.when(F.col("event_type") == "error", "failed_all").when(F.col("event_type") == "view", "").otherwise("TIER_1_API")
    made = rules.carry_forward(outcome, F.col("event_type") != "signup", tier, F.floor("value") % 5)
    return table(spark, d, "events").select("event_id", made.alias("r")).select("event_id", "r.*")


@query("q_f34_verdicts", """WITH r AS (SELECT l_orderkey AS k, count(*) AS n, count(*) FILTER (l_extendedprice > 50000) AS bad FROM lineitem GROUP BY 1)
SELECT k AS l_orderkey, CASE WHEN k % 10 = 0 THEN 'CARRY_FORWARD' WHEN k % 10 = 1 THEN 'FAILED_UNREACHABLE' WHEN k % 10 = 2 THEN 'FAILED_NO_DATA' WHEN bad > n - bad THEN 'PARTIAL' ELSE 'SUCCESS' END AS verdict,
CASE WHEN k % 10 = 0 THEN 'carry_forward' WHEN k % 10 = 1 THEN 'fetch' WHEN k % 10 = 2 THEN 'extract' WHEN bad > n - bad THEN 'validate' ELSE 'extract' END AS source FROM r""")
def verdicts(spark, d):
    k = F.col("l_orderkey")
    r = table(spark, d, "lineitem").groupBy("l_orderkey").agg(n_rows().alias("n"), F.count_if(F.col("l_extendedprice") > v.RENT_MOST).alias("bad"))
    outcome = F.when(k % 10 == 1, "TRANSIENT").when(k % 10 == 3, "NOT_MODIFIED").otherwise("OK")
    made = rules.verdict(k % 10 == 0, outcome, F.when(k % 10 != 2, F.col("n")), F.col("n") - F.col("bad"), F.col("bad"))
    return r.select("l_orderkey", made.alias("r")).select("l_orderkey", "r.*")


@query("q_f35_route", """SELECT c_custkey, CASE WHEN c_custkey % 3 < 2 THEN (c_custkey % 5)::INT END AS skip_to_tier, c_custkey % 3 <> 0 AS full_cascade,
CASE WHEN c_custkey % 3 < 2 OR c_custkey % 2 = 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 30000 ELSE 60000 END END AS timeout_ms FROM customer""")
def route(spark, d):
    k = F.col("c_custkey")
    made = rules.route(choice(k, "HOT", "WARM", "COLD"), (k % 5).cast("int"), F.when(k % 2 == 0, 30_000).otherwise(60_000))
    return table(spark, d, "customer").select("c_custkey", made.alias("r")).select("c_custkey", "r.*")


@query("q_t08_demotion", f"""WITH {UNITS}, r AS (SELECT id, year(day) AS run, count(*) AS n, count(*) FILTER (asking < 150000) AS rentless FROM units GROUP BY 1, 2),
l AS (SELECT *, coalesce(lag(n) OVER (PARTITION BY id ORDER BY run), 0) AS expected, ['HOT', 'WARM', 'COLD'][id % 3 + 1] AS m FROM r),
s AS (SELECT *, CASE WHEN m <> 'COLD' AND expected > 0 AND n < expected * 0.7 THEN 'unit_count_drop' END AS a, CASE WHEN m <> 'COLD' AND rentless = n THEN 'all_rents_null' END AS b, CASE WHEN m <> 'COLD' AND id % 7 = 0 AND id % 4 >= 2 THEN 'timeout_pattern' END AS c FROM l)
SELECT id, run::INT AS run, concat_ws(',', a, b, c) AS reasons, CASE WHEN b IS NOT NULL OR c IS NOT NULL THEN 'COLD' WHEN a IS NOT NULL AND m = 'HOT' THEN 'WARM' ELSE m END AS maturity FROM s""")
def demotion(spark, d):
    r = units(spark, d).groupBy("id", F.year("day").alias("run")).agg(n_rows().alias("n"), F.count_if(F.col("asking") < 150_000).alias("rentless"))
    r = r.withColumn("expected", F.coalesce(F.lag("n").over(Window.partitionBy("id").orderBy("run")), F.lit(0)))
    i = F.col("id")
    made = rules.drift(choice(i, "HOT", "WARM", "COLD"), F.col("expected"), F.col("n"), F.col("rentless"), i % 7 == 0, i % 4)
    return r.select("id", "run", made.alias("r")).select("id", "run", F.array_join("r.reasons", ",").alias("reasons"), "r.maturity")


@query("q_t06_next_retry", "SELECT event_id, ts + to_hours(event_id % 12) + CASE WHEN event_id % 12 < 6 THEN INTERVAL 1 HOUR ELSE INTERVAL 1 DAY END AS retry_at FROM events")
def next_retry(spark, d):
    now = F.expr("ts + make_dt_interval(0, CAST(event_id % 12 AS INT))")
    return table(spark, d, "events").select("event_id", rules.next_retry(F.col("ts"), now).alias("retry_at"))


@query("q_p27_due", """WITH e AS (SELECT event_id, event_id % 2 = 0 AS stable, hour(timezone(CASE event_id % 5 WHEN 1 THEN 'America/Chicago' WHEN 2 THEN 'America/Denver' WHEN 3 THEN 'America/Phoenix' ELSE 'America/New_York' END, ts AT TIME ZONE 'UTC')) AS h FROM events)
SELECT event_id, CASE WHEN stable THEN h >= 2 ELSE h IN (8, 12, 16, 20) END AS due FROM e""")
def due(spark, d):
    i = F.col("event_id")
    return table(spark, d, "events").select("event_id", rules.schedule_due(choice(i, "STABILISED", "LEASE_UP"), choice(i, "NY", "tx", "CO", "AZ", None), F.col("ts")).alias("due"))


@query("q_p12_status", "SELECT event_id, CASE WHEN event_type = 'view' THEN 'FAILED' WHEN event_id % 3 = 0 THEN 'CARRIED_FORWARD' WHEN event_type = 'error' THEN 'FAILED' WHEN event_id % 4 = 0 THEN 'STALE' ELSE 'SUCCESS' END AS status FROM events")
def status(spark, d):
    i, kind = F.col("event_id"), F.col("event_type")
    return table(spark, d, "events").select("event_id", rules.scrape_status(kind != "view", i % 3 == 0, kind == "error", F.when(i % 4 == 0, "STALE").when(i % 4 == 1, "")).alias("status"))


# URLs and providers ---------------------------------------------------------------------------------------------------
@query("q_p23_unit_api", "SELECT page_id, page_id % 6 IN (0, 3) AS may_hold FROM pages")
def unit_api(spark, d):
    """A path of units on the page's host, a denied host, a denied part, an allowed host below a portal, no path of units, a look-alike."""
    i = F.col("page_id")
    host = F.when(i % 6 == 1, "https://maps.googleapis.com").when(i % 6 == 3, "https://api.ws.realpage.com").otherwise(F.concat(F.lit("https://"), v.host(F.col("url"))))
    tail = choice(i, "/API/v1/Units", "/api/units", "/api/beacon?x=1", "/v2/units", "/blog", "/apart/ment")
    return table(spark, d, "pages").select("page_id", rules.unit_api(F.concat(host, tail)).alias("may_hold"))


@query("q_f36_provider", """SELECT page_id, ['onesite', 'realpage_oll', 'rentcafe', 'entrata', 'custom', 'appfolio', 'unknown', 'rentcafe', 'entrata'][page_id % 9 + 1] AS pms,
[0.95, 0.80, 0.90, 0.95, 0.75, 0.80, 0.0, 0.70, 0.85][page_id % 9 + 1]::DOUBLE AS confidence FROM pages""")
def provider(spark, d):
    i, own = F.col("page_id"), v.host(F.col("url"))
    site = lambda tail: F.concat(F.lit("https://"), own, F.lit(tail))
    url = F.when(i % 9 == 0, "https://1234.onlineleasing.realpage.com/x").when(i % 9 == 1, "https://portal.realpage.com").when((i % 9).isin(2, 7), site("/Plans.ASPX")).otherwise(site("/"))
    page = F.concat(F.col("html"), F.when(i % 9 == 2, "Yardi").when(i % 9 == 3, "static.wix.com").when(i % 9 == 5, "x.appfolio.com").when(i % 9 == 8, "/Apartments/Module/").otherwise(""))
    company = F.when(i % 9 == 7, "Nobody").when(i % 9 == 3, " Mark-Taylor ")
    hint = F.when(i % 9 == 3, " Entrata").when(i % 9 == 4, "homemade").when(i % 9 == 5, "")
    seen = table(spark, d, "pages").select("page_id", url.alias("url"), page.alias("page"), company.alias("company"), hint.alias("hint"))
    return frames.with_provider(seen, "url", "page", "company", "hint").select("page_id", "provider.pms", F.round("provider.confidence", 10).alias("confidence"))


HREFS = """links AS (SELECT page_id, url, regexp_extract(url, '^([^:]+://[^/?#]*)', 1) AS origin, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages)"""


def links(spark, d):
    return table(spark, d, "pages").select("page_id", "url", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("href"))


@query("q_f37_absolute_links", f"""WITH {HREFS} SELECT page_id, href, CASE WHEN trim(href) LIKE '/%' THEN origin || trim(href) WHEN trim(href) LIKE 'http%' AND regexp_replace(lower(regexp_extract(trim(href), '^[^:]+://([^/?#]*)', 1)), '^www\\.', '') = regexp_replace(lower(regexp_extract(url, '^[^:]+://([^/?#]*)', 1)), '^www\\.', '') THEN trim(href) END AS absolute FROM links""")
def absolute_links(spark, d):
    return links(spark, d).select("page_id", "href", rules.absolute_url(F.col("url"), F.col("href")).alias("absolute"))


_WORDS = " OR ".join(f"contains(lower(href), '{w}')" for w in rules.PROPERTY_WORDS)


@query("q_p26_property_links", f"WITH {HREFS} SELECT page_id, count(*) AS n_links, count(*) FILTER ({_WORDS}) AS n_property FROM links GROUP BY 1")
def property_links(spark, d):
    return links(spark, d).groupBy("page_id").agg(n_rows().alias("n_links"), F.count_if(rules.property_link(F.col("href"))).alias("n_property"))


_LEVELS = f"""{HREFS}, l AS (SELECT page_id, '/units/' || page_id AS href, 0 AS level FROM pages UNION ALL SELECT page_id, href, CASE WHEN {_WORDS} THEN 1 WHEN length(href) > 8 THEN 2 ELSE 3 END FROM links)"""


@query("q_o07_link_levels", f"WITH {_LEVELS}, b AS (SELECT page_id, href, min(level) AS level FROM l GROUP BY 1, 2) SELECT page_id, href, level, row_number() OVER (PARTITION BY page_id ORDER BY level, href) AS place FROM b")
def link_levels(spark, d):
    """A hint of each page leads, then links about units, then others; a link found at several levels keeps the best (O06, O07)."""
    href = F.col("href")
    level = F.when(rules.property_link(href), 1).when(F.length(href) > 8, 2).otherwise(3)
    hints = table(spark, d, "pages").select("page_id", F.concat(F.lit("/units/"), F.col("page_id").cast("string")).alias("href"), F.lit(0).alias("level"))
    best = hints.unionByName(links(spark, d).select("page_id", "href", level.alias("level"))).groupBy("page_id", "href").agg(F.min("level").alias("level"))
    return best.withColumn("place", F.row_number().over(Window.partitionBy("page_id").orderBy("level", "href")))


@query("q_j20_unexplored", f"WITH {HREFS} SELECT DISTINCT l.page_id, l.href FROM links l WHERE NOT EXISTS (SELECT 1 FROM links s WHERE s.href = l.href AND s.page_id % 2 = 0 AND s.page_id // 10 = l.page_id // 10)")
def unexplored(spark, d):
    """Links not among those that even pages of the same block of ten have."""
    every = links(spark, d).select("page_id", F.floor(F.col("page_id") / 10).alias("block"), "href")
    seen = every.where("page_id % 2 = 0").select("block", "href").distinct()
    return every.join(seen, ["block", "href"], "left_anti").select("page_id", "href").distinct()


@query("q_x27_banner", "SELECT doc_id, regexp_matches(lower(text), 'free|off|concession|special|limited|weeks free|months free|move in|look and lease') AS banner FROM documents")
def banner(spark, d):
    """Whether a text speaks of an offer. The words are fixed values."""
    words = ("free", "off", "concession", "special", "limited", "weeks free", "months free", "move in", "look and lease")
    return table(spark, d, "documents").select("doc_id", F.lower("text").rlike("|".join(words)).alias("banner"))


@query("q_x33_signals", """SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[^:]+://([^/?#:]*)', 1)), '^www\\.', '') AS host, regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1) AS path,
contains(lower(html), 'entrata.com') OR contains(lower(html), '/apartments/module/') OR contains(lower(html), 'entrata-widget') AS entrata, contains(lower(html), 'rentcafe') OR contains(lower(html), 'yardi') AS rentcafe, len(regexp_extract_all(lower(html), '<script'))::INT AS n_scripts, len(regexp_extract_all(lower(html), '<iframe'))::INT AS n_iframes FROM pages""")
def signals(spark, d):
    low = F.lower("html")
    marks = {name: words for words, name, _ in rules.PROVIDER_MARKS}
    flag = lambda name: F.expr(" OR ".join(f"contains(lower(html), '{w}')" for w in marks[name])).alias(name)
    return table(spark, d, "pages").select("page_id", F.regexp_replace(v.host(F.col("url")), r":\d+$", "").alias("host"), rules.url_path(F.col("url")).alias("path"), flag("entrata"), flag("rentcafe"), F.regexp_count(low, F.lit("<script")).alias("n_scripts"), F.regexp_count(low, F.lit("<iframe")).alias("n_iframes"))


# Joins, state and sets ------------------------------------------------------------------------------------------------
@query("q_j02_ledger", f"""WITH {PROPERTIES}, l AS (SELECT user_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT id, name, event_type AS last_event, value AS last_value FROM props LEFT JOIN l ON id = user_id""")
def ledger(spark, d):
    last = frames.latest_by_struct(table(spark, d, "events").select("user_id", "ts", "event_id", "event_type", "value"), ["user_id"], ["ts", "event_id"])
    return properties(spark, d).join(last, F.col("id") == F.col("user_id"), "left").select("id", "name", F.col("event_type").alias("last_event"), F.col("value").alias("last_value"))


@query("q_j17_replay", "SELECT user_id, ts::DATE AS day, count(*) AS n, max_by(value, (ts, event_id)) FILTER (event_type = 'purchase') AS last_won FROM events GROUP BY 1, 2")
def replay(spark, d):
    """What a property and day can be replayed from: its events and the last one that won."""
    won = F.when(F.col("event_type") == "purchase", F.struct("ts", "event_id"))
    return table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(n_rows().alias("n"), F.max_by("value", won).alias("last_won"))


@query("q_j18_failures", f"WITH {PROPERTIES} SELECT event_id, user_id, coalesce(name, user_id::VARCHAR) AS name FROM events LEFT JOIN props ON user_id = id AND id % 3 <> 0 WHERE event_type = 'error'")
def failures(spark, d):
    """Failures with the property's name, or its id where there is none."""
    named = properties(spark, d).where("id % 3 <> 0").select("id", "name")
    e = table(spark, d, "events").where("event_type = 'error'").select("event_id", "user_id")
    return e.join(named, F.col("user_id") == F.col("id"), "left").select("event_id", "user_id", F.coalesce("name", F.col("user_id").cast("string")).alias("name"))


@query("q_p18_retry_ledger", f"""WITH {PROPERTIES}, l AS (SELECT user_id, event_type AS t, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT id, coalesce(t, 'absent') AS state FROM props LEFT JOIN l ON id = user_id WHERE t IS NULL OR t = 'error' OR (t = 'purchase' AND value < 50)""")
def retry_ledger(spark, d):
    """Properties to run again: absent from the ledger, failed, or a success without units."""
    last = frames.latest_by_struct(table(spark, d, "events").select("user_id", "ts", "event_id", "event_type", "value"), ["user_id"], ["ts", "event_id"])
    again = F.col("event_type").isNull() | (F.col("event_type") == "error") | ((F.col("event_type") == "purchase") & (F.col("value") < 50))
    return properties(spark, d).join(last, F.col("id") == F.col("user_id"), "left").where(again).select("id", F.coalesce("event_type", F.lit("absent")).alias("state"))


@query("q_k06_upsert", """WITH a AS (SELECT user_id::VARCHAR AS url, min(ts) AS first_seen, min(event_id % 7) AS depth, min(event_type) AS source FROM events WHERE event_type < 'p' GROUP BY 1),
b AS (SELECT user_id::VARCHAR AS url, min(ts) AS first_seen, min(event_id % 5) AS depth, min(event_type) AS source FROM events WHERE event_type >= 'p' GROUP BY 1)
SELECT url, coalesce(a.first_seen, b.first_seen) AS first_seen, least(a.depth, b.depth) AS depth, coalesce(b.source, a.source) AS source FROM a FULL JOIN b USING (url)""")
def upsert(spark, d):
    def side(test: str, mod: int):
        e = table(spark, d, "events").where(test)
        return e.groupBy(F.col("user_id").cast("string").alias("url")).agg(F.min("ts").alias("first_seen"), F.min(F.col("event_id") % mod).alias("depth"), F.min("event_type").alias("source"))

    return files.upsert_frontier(side("event_type < 'p'", 7), side("event_type >= 'p'", 5))


@query("q_t15_skips", """WITH r AS (SELECT user_id, ts::DATE AS day, count(*) AS n FROM events GROUP BY 1, 2), c AS (SELECT *, n = lag(n) OVER (PARTITION BY user_id ORDER BY day) AS same FROM r),
i AS (SELECT *, sum(CASE WHEN coalesce(same, false) THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY day) AS island FROM c)
SELECT user_id, day, row_number() OVER (PARTITION BY user_id, island ORDER BY day) - 1 AS carryforward_days FROM i""")
def skips(spark, d):
    """Days in a row on which a property gave what it gave before."""
    r = table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(n_rows().alias("n"))
    same = F.col("n") == F.lag("n").over(Window.partitionBy("user_id").orderBy("day"))
    return frames.streaks(r.withColumn("same", same), ["user_id"], F.col("same"), F.col("day")).select("user_id", "day", F.col("streak").alias("carryforward_days"))


@query("q_t16_provider_update", """WITH e AS (SELECT user_id, event_type, value / 500 AS sure, ts, event_id FROM events) SELECT user_id, coalesce(max_by(event_type, (ts, event_id)) FILTER (sure >= 0.2), 'unknown') AS provider, count(*) AS n FROM e GROUP BY 1""")
def provider_update(spark, d):
    """The newest sure sighting names the provider; unsure ones change nothing."""
    sure = F.when(F.col("value") / 500 >= 0.2, F.struct("ts", "event_id"))
    return table(spark, d, "events").groupBy("user_id").agg(F.coalesce(F.max_by("event_type", sure), F.lit("unknown")).alias("provider"), n_rows().alias("n"))


@query("q_x29_caps", "WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) SELECT user_id, string_agg(event_id::VARCHAR, ',' ORDER BY rn DESC) AS kept FROM r WHERE rn <= 50 GROUP BY 1")
def caps(spark, d):
    """A profile's list keeps its newest 50 entries, oldest first: ranked before they are collected, so no list grows beyond that."""
    newest = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    r = table(spark, d, "events").select("user_id", "event_id", F.row_number().over(newest).alias("rn")).where("rn <= 50")
    got = F.sort_array(F.collect_list(F.struct((-F.col("rn")).alias("at"), F.col("event_id").cast("string").alias("e"))))
    return r.groupBy("user_id").agg(F.array_join(F.transform(got, lambda x: x["e"]), ",").alias("kept"))


@query("q_u06_toggle", "SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN CASE event_type WHEN 'view' THEN 'click' ELSE 'view' END ELSE 'view,click,' || event_type END AS picked FROM events")
def toggle(spark, d):
    base, x = F.array(F.lit("view"), F.lit("click")), F.col("event_type")
    return table(spark, d, "events").select("event_id", F.array_join(F.when(F.array_contains(base, x), F.array_remove(base, x)).otherwise(F.array_append(base, x)), ",").alias("picked"))


# Identity, checks and aggregates --------------------------------------------------------------------------------------
_IDS = f"""{PROPERTIES}, ids AS (SELECT id, CASE WHEN id % 7 = 0 THEN NULL WHEN id % 5 = 0 THEN 'web_' || city WHEN id % 3 = 0 THEN 'addr_' || name ELSE name END AS canonical_id,
CASE WHEN id % 7 = 0 THEN 'unresolved' WHEN id % 5 = 0 THEN 'website' WHEN id % 3 = 0 THEN 'address' ELSE 'unique' END AS source FROM props)"""


def identities(spark, d):
    i = F.col("id")
    found = {
        "unique": F.when((i % 7 != 0) & (i % 5 != 0) & (i % 3 != 0), F.col("name")),
        "address": F.when((i % 7 != 0) & (i % 5 != 0) & (i % 3 == 0), F.concat(F.lit("addr_"), F.col("name"))),
        "website": F.when((i % 7 != 0) & (i % 5 == 0), F.concat(F.lit("web_"), F.col("city"))),
    }
    ident, source, confidence = v.identity(found)
    return properties(spark, d).select("id", ident.alias("canonical_id"), source.alias("source"), confidence.alias("confidence"))


@query("q_a27_by_source", f"WITH {_IDS} SELECT s.source, count(i.id) AS n FROM (VALUES ('unique'), ('property'), ('address'), ('geo'), ('website'), ('unresolved')) s(source) LEFT JOIN ids i ON i.source = s.source GROUP BY 1")
def by_source(spark, d):
    """Identities by source, with zeros: one aggregate row, unfolded."""
    names = [*(k for k, _ in v.IDENTITY), "unresolved"]
    one = identities(spark, d).agg(*[F.count_if(F.col("source") == s).alias(s) for s in names])
    return one.select(F.explode(F.array(*[F.struct(F.lit(s).alias("source"), F.col(s).alias("n")) for s in names])).alias("r")).select("r.*")


@query("q_a32_resolution", f"WITH {_IDS}, g AS (SELECT canonical_id, count(*) AS n FROM ids GROUP BY 1) SELECT sum(n)::BIGINT AS total, coalesce(sum(n - 1) FILTER (canonical_id IS NOT NULL), 0)::BIGINT AS merged, coalesce(sum(n) FILTER (canonical_id IS NULL), 0)::BIGINT AS unresolved FROM g")
def resolution(spark, d):
    g = identities(spark, d).groupBy("canonical_id").agg(n_rows().alias("n"))
    known = F.col("canonical_id").isNotNull()
    return g.agg(F.sum("n").alias("total"), F.coalesce(F.sum(F.when(known, F.col("n") - 1)), F.lit(0)).alias("merged"), F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("unresolved"))


@query("q_v07_identity_issues", f"""WITH {_IDS} SELECT id::VARCHAR AS subject, 'ERROR' AS severity, 'IDENTITY_UNRESOLVED' AS code FROM ids WHERE canonical_id IS NULL
UNION ALL SELECT id::VARCHAR, 'WARNING', 'IDENTITY_LOW_CONFIDENCE' FROM ids WHERE source = 'website'
UNION ALL SELECT canonical_id, 'ERROR', 'DUPLICATE_IDENTITY' FROM ids WHERE canonical_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
def identity_issues(spark, d):
    ids = identities(spark, d)
    missing = F.col("canonical_id").isNull()
    single = frames.issues(ids.withColumn("subject", F.col("id").cast("string")), ["subject"], [("ERROR", "IDENTITY_UNRESOLVED", missing), ("WARNING", "IDENTITY_LOW_CONFIDENCE", ~missing & (F.col("confidence") < 0.70))])
    twice = frames.duplicates(ids, "canonical_id", []).select(F.col("value").alias("subject"), F.lit("ERROR").alias("severity"), F.lit("DUPLICATE_IDENTITY").alias("code"))
    return single.unionByName(twice)


@query("q_v03_issues", """WITH u AS (SELECT l_orderkey, l_linenumber, (l_quantity % 9)::INT AS beds, l_tax * 50 AS baths, (l_quantity - 3)::INT AS area, l_extendedprice AS lo, l_extendedprice * (1.05 - l_discount) AS hi, (l_quantity % 4)::INT AS term, CASE WHEN l_returnflag <> 'R' THEN l_shipdate END AS captured FROM lineitem)
SELECT l_orderkey, l_linenumber, 'WARNING' AS severity, 'V2_INVALID_BEDS' AS code FROM u WHERE beds > 7
UNION ALL SELECT l_orderkey, l_linenumber, 'WARNING', 'V2_INVALID_BATHS' FROM u WHERE baths NOT BETWEEN 0 AND 10 OR baths * 2 <> floor(baths * 2)
UNION ALL SELECT l_orderkey, l_linenumber, 'WARNING', 'V2_INVALID_AREA' FROM u WHERE area <> -1 AND area <= 0
UNION ALL SELECT l_orderkey, l_linenumber, 'WARNING', 'V2_INVALID_RENT' FROM u WHERE lo > hi
UNION ALL SELECT l_orderkey, l_linenumber, 'WARNING', 'V2_INVALID_LEASE_TERM' FROM u WHERE term <= 1
UNION ALL SELECT l_orderkey, l_linenumber, 'ERROR', 'V2_MISSING_REQUIRED' FROM u WHERE captured IS NULL""")
def v2_issues(spark, d):
    q = F.col("l_quantity")
    u = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (q % 9).cast("int").alias("beds"), (F.col("l_tax") * 50).alias("baths"), (q - 3).cast("int").alias("area"), F.col("l_extendedprice").alias("lo"), (F.col("l_extendedprice") * (1.05 - F.col("l_discount"))).alias("hi"), (q % 4).cast("int").alias("term"), F.when(F.col("l_returnflag") != "R", F.col("l_shipdate")).alias("captured"))
    baths, w = F.col("baths"), "WARNING"
    found = [
        (w, "V2_INVALID_BEDS", ~F.col("beds").between(0, 7)),
        (w, "V2_INVALID_BATHS", ~baths.between(0, 10) | (baths * 2 != F.floor(baths * 2))),
        (w, "V2_INVALID_AREA", (F.col("area") != -1) & (F.col("area") <= 0)),
        (w, "V2_INVALID_RENT", F.col("lo") > F.col("hi")),
        (w, "V2_INVALID_LEASE_TERM", F.col("term") <= 1),
        ("ERROR", "V2_MISSING_REQUIRED", F.col("captured").isNull()),
    ]
    return frames.issues(u, ["l_orderkey", "l_linenumber"], found)


@query("q_v08_property_issues", f"""WITH {PROPERTIES}, e AS (SELECT user_id, count(*) FILTER (event_type = 'error') AS bad, count(*) FILTER (event_type = 'view') AS views FROM events GROUP BY 1),
j AS (SELECT id, balance, user_id, bad, views FROM props LEFT JOIN e ON id = user_id)
SELECT id, 'ERROR' AS severity, 'SCRAPE_ERRORS' AS code FROM j WHERE bad > 0 UNION ALL SELECT id, 'WARNING', 'NO_APIS' FROM j WHERE views = 0 UNION ALL SELECT id, 'WARNING', 'DISAPPEARED' FROM j WHERE user_id IS NULL UNION ALL SELECT id, 'ERROR', 'MISSING_URL' FROM j WHERE balance < 0""")
def property_issues(spark, d):
    e = table(spark, d, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("bad"), F.count_if(F.col("event_type") == "view").alias("views"))
    j = properties(spark, d).select("id", "balance").join(e, F.col("id") == F.col("user_id"), "left")
    return frames.issues(j, ["id"], [("ERROR", "SCRAPE_ERRORS", F.col("bad") > 0), ("WARNING", "NO_APIS", F.col("views") == 0), ("WARNING", "DISAPPEARED", F.col("user_id").isNull()), ("ERROR", "MISSING_URL", F.col("balance") < 0)])


@query("q_p21_low_signal", "SELECT l_orderkey, count(*) FILTER (l_extendedprice BETWEEN 200 AND 50000 OR l_returnflag = 'A') = 0 AS low_signal FROM lineitem GROUP BY 1")
def low_signal(spark, d):
    """Orders none of whose lines has a sane rent or an id (P19, P21)."""
    rent = F.when(v.rent_is_sane(F.col("l_extendedprice")), F.col("l_extendedprice"))
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg((F.count_if(rent.isNotNull() | (F.col("l_returnflag") == "A")) == 0).alias("low_signal"))


@query("q_p02_pick", f"WITH {PROPERTIES} SELECT id, CASE WHEN id % 3 = 1 THEN 'null' WHEN id % 3 = 0 THEN name ELSE city END AS name FROM props")
def pick(spark, d):
    """A given value wins over a found one unless it is blank or the word for missing; NULL in capitals is kept, as by the rule."""
    given = F.when(F.col("id") % 3 == 0, F.col("name")).when(F.col("id") % 3 == 2, " None ").otherwise(" ")
    found = F.when(F.col("id") % 3 == 1, F.lit("NULL")).otherwise(F.col("city"))
    return properties(spark, d).select("id", F.regexp_replace(v.first_clean(given, found, words="pick"), "^NULL$", "null").alias("name"))


@query("q_p31_map_points", f"WITH {PROPERTIES} SELECT id, balance AS lat, (id % 5)::DOUBLE AS lng FROM props WHERE balance <> 0 AND id % 5 <> 0")
def map_points(spark, d):
    return properties(spark, d).select("id", F.col("balance").alias("lat"), (F.col("id") % 5).cast("double").alias("lng")).where("lat <> 0 AND lng <> 0")


@query("q_p08_summary_v2", f"""WITH {UNITS}, u AS (SELECT id, CASE WHEN asking > 100000 THEN asking ELSE 0 END AS lo, CASE WHEN unit_id % 3 = 0 THEN 0 ELSE asking END AS hi, available FROM units)
SELECT id, count(*) AS total_units, count(*) FILTER (available) AS available_units, round(avg(CASE WHEN lo > 0 AND hi > 0 THEN (lo + hi) / 2 ELSE greatest(lo, hi) END), 4) AS avg_asking FROM u GROUP BY 1""")
def summary_v2(spark, d):
    """Asking rent is the mean of both ends where both are known, else the known one."""
    u = units(spark, d)
    lo, hi = F.when(F.col("asking") > 100_000, F.col("asking")).otherwise(0.0), F.when(F.col("unit_id") % 3 == 0, 0.0).otherwise(F.col("asking"))
    asking = F.when((lo > 0) & (hi > 0), (lo + hi) / 2).otherwise(F.greatest(lo, hi))
    return u.groupBy("id").agg(n_rows().alias("total_units"), F.count_if("available").alias("available_units"), F.round(F.avg(asking), 4).alias("avg_asking"))


# Scalars --------------------------------------------------------------------------------------------------------------
@query("q_f06_address_fp", """SELECT s_suppkey, 'addr_' || left(sha1(lower(trim(regexp_replace(s_name, '[^A-Za-z0-9_]+', ' ', 'g'))) || '|' || lower(n_name) || '|' || lower(r_name) || '|' || lpad(s_suppkey::VARCHAR, 5, '0')), 16) AS fp
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def address_fp(spark, d):
    """Fingerprint of address, city, state and leading ZIP (F02, F05, F06). Nation and region are fixed, small tables."""
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    places = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    s = table(spark, d, "supplier").join(F.broadcast(places), F.col("s_nationkey") == F.col("n_nationkey"))
    code = F.concat(F.lpad(F.col("s_suppkey").cast("string"), 5, "0"), F.lit("-1234"))
    return s.select("s_suppkey", v.address_fingerprint(F.col("s_name"), F.col("n_name"), F.col("r_name"), code).alias("fp"))


@query("q_f20_short_years", "SELECT o_orderkey, '20' || strftime(o_orderdate, '%y-%m-%d') AS day FROM orders")
def short_years(spark, d):
    return table(spark, d, "orders").select("o_orderkey", v.us_date(F.date_format("o_orderdate", "M/d/yy")).alias("day"))


@query("q_f22_numbers", "SELECT l_orderkey, l_linenumber, trunc(l_extendedprice)::BIGINT AS whole, greatest(0.0, least(1.0, l_quantity / 40)) AS share FROM lineitem")
def numbers(spark, d):
    """Whole numbers out of text with thousands separators, and shares held to 0..1 (F22, F27, F28)."""
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", v.safe_int(F.format_number("l_extendedprice", 2)).alias("whole"), v.clamp01(F.col("l_quantity") / 40).alias("share"))


@query("q_f41_defaults", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'LEASED' ELSE 'AVAILABLE' END AS status, CASE WHEN o_orderkey % 4 = 0 THEN DATE '2026-01-01' ELSE o_orderdate::DATE END AS available_on FROM orders")
def defaults(spark, d):
    """Unknown availability counts as available, and a missing date as the run's."""
    given = F.when(F.col("o_orderstatus") == "F", "LEASED").when(F.col("o_orderstatus") == "P", "UNKNOWN")
    status = F.coalesce(F.nullif(given, F.lit("UNKNOWN")), F.lit("AVAILABLE"))
    day = F.when(F.col("o_orderkey") % 4 != 0, F.to_date("o_orderdate"))
    return table(spark, d, "orders").select("o_orderkey", status.alias("status"), F.coalesce(day, F.lit("2026-01-01").cast("date")).alias("available_on"))


# Pages and profiles ---------------------------------------------------------------------------------------------------
@query("q_x17_embedded", """WITH t AS (SELECT l_orderkey, l_linenumber, '{"unit":"' || l_partkey || '","rent":' || floor(l_extendedprice)::BIGINT || '}' AS t FROM lineitem),
j AS (SELECT l_orderkey AS page_id, 2 + length(string_agg(t, ',' ORDER BY l_linenumber, t)) AS n FROM t GROUP BY 1)
SELECT page_id, 'embedded:json-block:list' AS url, n::INT AS n FROM j WHERE n >= 200 UNION ALL SELECT page_id, 'embedded:script-var:unitList', n::INT FROM j WHERE n + 16 >= 300
UNION ALL SELECT page_id, u, (n + 10)::INT FROM j, (VALUES ('embedded:script-var:pageData'), ('embedded:js:pageData')) x(u) WHERE n + 29 >= 300""")
def embedded(spark, d):
    """JSON found again in pages written from orders: a typed block, an assignment and a global; one broken text gives nothing."""
    one = F.concat(F.lit('{"unit":"'), F.col("l_partkey").cast("string"), F.lit('","rent":'), F.floor("l_extendedprice").cast("string"), F.lit("}"))
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("page_id")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", one.alias("t")))).alias("lines"))
    text = F.concat(F.lit("["), F.array_join(F.transform("lines", lambda x: x["t"]), ","), F.lit("]"))
    parts = ('<p>units</p><script type="application/json" id="list">', text, "</script><script>var unitList = ", text, ";</script><script>window.pageData = {\"units\":", text, "};</script><script type='application/json'>{broken", text, "</script>")
    pages = lines.select("page_id", F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]).alias("html"))
    return html_units.embedded_json(pages).select("page_id", "url", F.length("body").alias("n"))


@query("q_x30_migration", """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'entrata' WHEN c_custkey % 2 = 0 THEN 'rentcafe' ELSE 'unknown' END AS provider, least(50, c_custkey % 70)::INT AS n_blocked, least(20, c_custkey % 30)::INT AS n_mappings, least(50, c_custkey % 80)::INT AS n_explored,
CASE WHEN c_custkey % 3 <> 0 AND c_custkey % 2 = 0 THEN 0.95 END AS confidence, 2 AS version FROM customer""")
def migration(spark, d):
    k = F.col("c_custkey")
    many = lambda n: F.transform(F.filter(F.sequence(F.lit(0), (k % n).cast("int")), lambda x: x > 0), lambda x: x.cast("string"))
    old = table(spark, d, "customer").select(
        "c_custkey",
        F.struct(choice(k, "entrata", "", None).alias("api_provider"), many(70).alias("blocked_endpoints"), many(30).alias("llm_field_mappings")).alias("api_hints"),
        F.struct(F.lit("x").alias("platform_detected"), F.lit(1).alias("other")).alias("dom_hints"),
        F.struct(F.when(k % 2 == 0, "https://a.rentcafe.com/x").otherwise("https://example.com").alias("entry_url"), many(80).alias("explored_links")).alias("navigation"),
        F.lit(7).alias("cluster_id"),
    )
    new = frames.migrate_profiles(old)
    return new.select("c_custkey", F.col("api_hints.api_provider").alias("provider"), F.size("api_hints.blocked_endpoints").alias("n_blocked"), F.size("api_hints.llm_field_mappings").alias("n_mappings"), F.size("navigation.explored_links").alias("n_explored"), F.col("last_success_detection.confidence").alias("confidence"), "version")


@query("q_f38_shape", r"""WITH h AS (SELECT page_id, html || CASE page_id % 3 WHEN 0 THEN '<script id="__NEXT_DATA__">{}</script>' WHEN 1 THEN ' $1,200/mo and $ 950 <IFRAME>' ELSE '' END AS html FROM pages),
m AS (SELECT page_id, octet_length(encode(html)) AS b, octet_length(encode(regexp_replace(regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'g'), '<[^>]+>', '', 'g'))) AS t,
len(regexp_extract_all(html, '(?i)<script\b')) AS s, len(regexp_extract_all(html, '(?i)<iframe\b')) AS i, len(regexp_extract_all(html, '(?i)\$\s?\d{3,4}(?:[,.]\d{3})?(?:/mo|\s*/\s*month)?')) AS r, contains(html, '__NEXT_DATA__') AS x FROM h)
SELECT page_id, b::INT AS body_bytes, t::INT AS text_bytes, s::INT AS n_scripts, i::INT AS n_iframes, r::INT AS n_rents, CASE WHEN x THEN 'next' ELSE '' END AS frameworks,
round_even(least(1.0::DOUBLE, 0.4::DOUBLE * (1 - least(1.0::DOUBLE, t / b)) + CASE WHEN x THEN 0.3::DOUBLE ELSE 0 END + CASE WHEN r = 0 AND t < 5000 THEN 0.3::DOUBLE ELSE 0 END), 2) AS spa FROM m""")
def shape(spark, d):
    more = choice(F.col("page_id"), '<script id="__NEXT_DATA__">{}</script>', " $1,200/mo and $ 950 <IFRAME>", "")
    pages = table(spark, d, "pages").select("page_id", F.concat("html", more).alias("html"))
    return html_units.page_shape(pages).withColumn("frameworks", F.array_join("frameworks", ","))
