"""Formats, retries, validated records, a day's metrics, readers by provider and kinds of payloads over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from leasegrid.functions import formats
from leasegrid.operators import outcomes
from leasegrid.plans.payload_queries import UNITS, generic_body, orders_as
from leasegrid.plans.tables import table

ALL: dict = {}


def query(name: str, sql: str | None = None):
    return lambda f: ALL.setdefault(name, (f, sql)) and f


@query("q_f40_formats", r"""WITH e AS (SELECT event_id, value, value / 7919 AS part, event_id * 37 AS n, date_trunc('second', ts) AS seen, event_type || ' ' || props AS t FROM events)
SELECT event_id, '$' || format('{:,}', round(value)::BIGINT) AS currency, CASE WHEN part = 0 THEN '$0.00' WHEN part < 0.01 THEN '$' || printf('%.4f', part) WHEN part < 1 THEN '$' || printf('%.3f', part) ELSE '$' || printf('%.2f', part) END AS cost,
printf('%.1f', part * 100) || '%' AS percent, strftime(seen, '%b %-d, %Y') AS day, strftime(seen, '%B %-d, %Y') AS long_day,
CASE d WHEN 0 THEN 'Today' WHEN 1 THEN 'Yesterday' ELSE CASE WHEN d < 7 THEN d || 'd ago' ELSE (d // 7) || 'w ago' END END AS relative_day,
CASE WHEN n < 60 THEN n || 's' WHEN n < 3600 THEN (n // 60) || 'm ' || (n % 60) || 's' ELSE (n // 3600) || 'h ' || (n // 60 % 60) || 'm' END AS duration,
CASE WHEN n < 1024 THEN n || 'B' WHEN n < 1048576 THEN printf('%.1f', round(n / 1024, 1)) || 'KB' ELSE printf('%.1f', round(n / 1048576, 1)) || 'MB' END AS size, format('{:,}', n) AS number,
CASE WHEN length(t) <= 12 THEN t ELSE left(t, 9) || '...' END AS shortened, left(regexp_replace(t, '[^\p{L}\p{N}_-]', '_', 'g'), 15) AS file_name
FROM (SELECT *, (epoch(TIMESTAMP '2024-02-01') - epoch(seen))::BIGINT // 86400 AS d FROM e)""")
def all_formats(spark, d):
    e = table(spark, d, "events")
    at, part, n, text = F.date_trunc("second", F.col("ts").cast("timestamp")), F.col("value") / 7919, F.col("event_id") * 37, F.concat_ws(" ", "event_type", "props")
    f = formats
    return e.select(
        "event_id", f.currency(F.col("value")).alias("currency"), f.cost(part).alias("cost"), f.percent(part).alias("percent"), f.date(at).alias("day"), f.date(at, "long").alias("long_day"),
        f.date(at, "relative", F.lit("2024-02-01").cast("timestamp")).alias("relative_day"), f.duration(n).alias("duration"), f.size(n).alias("size"), f.number(n).alias("number"), f.shortened(text, 12).alias("shortened"), f.file_name(text, 15).alias("file_name"),
    )


_OUTCOMES = "['OK', 'TRANSIENT', 'RATE_LIMITED', 'BOT_BLOCKED', 'PROXY_ERROR', 'HARD_FAIL', 'NOT_MODIFIED']"


@query("q_f30_retries", f"""WITH c AS (SELECT event_id, user_id, {_OUTCOMES}[user_id % 7 + 1] AS outcome, event_id % 4 + 1 AS attempt, CASE event_id % 3 WHEN 0 THEN (event_id % 50)::VARCHAR WHEN 1 THEN 'Wed, 21 Oct' END AS after FROM events),
j AS (SELECT *, outcome IN ('OK', 'HARD_FAIL', 'NOT_MODIFIED') OR attempt >= 3 OR (outcome = 'BOT_BLOCKED' AND attempt >= 2) AS no, floor(500 * pow(2, attempt - 1) * (0.75 + ('0x' || left(md5(event_id::VARCHAR), 8))::BIGINT / 4294967296 / 2))::BIGINT AS backoff FROM c)
SELECT event_id, NOT no AS should_retry, CASE WHEN no THEN 0 WHEN outcome = 'RATE_LIMITED' THEN CASE WHEN try_cast(after AS BIGINT) IS NULL THEN 5000 ELSE greatest(try_cast(after AS BIGINT) * 1000, 1000) END ELSE backoff END AS wait_ms, NOT no AND outcome IN ('BOT_BLOCKED', 'PROXY_ERROR') AS rotate_identity FROM j""")
def retries(spark, d):
    e = table(spark, d, "events")
    names = ["OK", "TRANSIENT", "RATE_LIMITED", "BOT_BLOCKED", "PROXY_ERROR", "HARD_FAIL", "NOT_MODIFIED"]
    outcome = F.get(F.array(*map(F.lit, names)), (F.col("user_id") % 7).cast("int"))
    after = F.when(F.col("event_id") % 3 == 0, (F.col("event_id") % 50).cast("string")).when(F.col("event_id") % 3 == 1, "Wed, 21 Oct")
    read = e.select("event_id", outcome.alias("outcome"), (F.col("event_id") % 4 + 1).alias("attempt"), after.alias("after"))
    return read.select("event_id", outcomes.retry(F.col("outcome"), F.col("attempt"), F.col("after"), F.col("event_id")).alias("r")).select("event_id", "r.*")


@query("q_v06_records", """WITH u AS (SELECT l_suppkey AS property, concat_ws('-', l_orderkey, l_linenumber, l_partkey, floor(l_extendedprice)::BIGINT, l_quantity::BIGINT, round(l_discount * 100)::BIGINT, l_returnflag) AS unit_id, floor(l_extendedprice)::BIGINT AS rent, (l_quantity - 3)::BIGINT AS area, l_returnflag AS plan, l_discount AS part FROM lineitem),
v AS (SELECT *, rent > 50000 AS absurd, area < 0 AS negative FROM u),
s AS (SELECT *, NOT absurd AND NOT negative AS fine, part * 10 > 0.5 AS dear FROM v)
SELECT property, unit_id, CASE WHEN NOT fine THEN 'rejected' WHEN dear THEN 'flagged' ELSE 'accepted' END AS status, concat_ws(',', CASE WHEN absurd THEN 'INVALID_RENT_ABSURD' END, CASE WHEN negative THEN 'INVALID_SQFT_NEGATIVE' END) AS reasons,
CASE WHEN fine AND dear THEN 'rent_swing_>50pct' ELSE '' END AS flags, sum((NOT fine)::INT) OVER (PARTITION BY property) / count(*) OVER (PARTITION BY property) > 0.5 AS next_tier FROM s""")
def checked(spark, d):
    """Line items as units of suppliers, named by all that counts; what was known of dear ones is half their rent."""
    u = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("property"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", F.floor("l_extendedprice"), F.col("l_quantity").cast("bigint"), F.round(F.col("l_discount") * 100).cast("bigint"), "l_returnflag").alias("unit_id"), F.floor("l_extendedprice").alias("rent"), (F.col("l_quantity") - 3).cast("bigint").alias("sqft"),
        F.col("l_returnflag").alias("floor_plan_name"), (F.col("l_discount") * 10 > 0.5).alias("dear"),
    )
    rent = F.when(F.col("dear"), F.col("rent") / 2).otherwise(F.col("rent")).cast("double")
    known = u.groupBy("property", "unit_id").agg(F.max(rent).alias("rent"), F.max(F.col("sqft").cast("double")).alias("area"), F.max("floor_plan_name").alias("plan"))
    found = outcomes.validated(u.drop("dear"), known, "property")
    return found.select("property", "unit_id", "status", F.array_join("reasons", ",").alias("reasons"), F.array_join("flags", ",").alias("flags"), "next_tier")


@query("q_a24_metrics", """WITH e AS (SELECT *, CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'SKIPPED' ELSE 'SUCCESS' END AS outcome, user_id % 4 AS tier, value > 150 AS vision, value > 1 AS banner FROM events),
d AS (SELECT * FROM e WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOUR), w AS (SELECT user_id % 20 AS domain, avg((outcome = 'FAILED')::INT) AS rate FROM e WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY GROUP BY 1),
m AS (SELECT 'properties' AS metric, count(DISTINCT user_id)::DOUBLE AS value FROM d UNION ALL SELECT 'success_rate', count(*) FILTER (outcome = 'SUCCESS') / count(*) FROM d
UNION ALL SELECT 'tier12_share', count(*) FILTER (outcome = 'SUCCESS' AND tier IN (1, 2)) / count(*) FILTER (outcome = 'SUCCESS') FROM d UNION ALL SELECT 'skip_rate', count(*) FILTER (outcome = 'SKIPPED') / count(*) FROM d
UNION ALL SELECT 'vision_rate', count(*) FILTER (vision) / count(*) FROM d UNION ALL SELECT 'banner_rate', count(*) FILTER (banner AND outcome <> 'SKIPPED') / count(*) FILTER (outcome <> 'SKIPPED') FROM d
UNION ALL SELECT 'p95_page_load_ms', quantile_disc(value * 100, 0.95) FROM d UNION ALL SELECT 'bad_domains', count(*) FILTER (rate > 0.05)::DOUBLE FROM w),
t(metric, target, least, most) AS (VALUES ('properties', '>= 500', 500, 1e18), ('success_rate', '>= 0.95', 0.95, 1e18), ('tier12_share', '>= 0.4', 0.4, 1e18), ('skip_rate', '>= 0.5', 0.5, 1e18), ('vision_rate', '<= 0.05', -1, 0.05), ('banner_rate', '>= 1', 1, 1e18), ('p95_page_load_ms', '< 30000', -1, 29999.999999), ('bad_domains', '<= 0', -1, 0))
SELECT metric, value, target, value >= least AND value <= most AS ok FROM m JOIN t USING (metric)""")
def metrics(spark, d):
    e = table(spark, d, "events")
    outcome = F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "signup", "SKIPPED").otherwise("SUCCESS")
    rows = e.select(F.col("user_id").alias("property_id"), "ts", outcome.alias("outcome"), (F.col("user_id") % 4).alias("tier"), (F.col("user_id") % 20).alias("domain"), (F.col("value") > 150).alias("vision"), (F.col("value") > 1).alias("banner"), (F.col("value") * 100).alias("page_load_ms"))
    # One row, and the same for every event.
    now = e.agg(F.max("ts")).first()[0]
    return outcomes.daily_metrics(rows, F.lit(now))


_PROVIDERS = ("rentcafe", "Wix_noPMS", "custom", "squarespace_nopms", "generic")


@query("q_x31_providers", f"""WITH {UNITS}, f AS (SELECT *, row_number() OVER (PARTITION BY payload_id, unit ORDER BY sqft, rent) AS turn FROM u)
SELECT payload_id, unit AS unit_number, '$' || format('{{:,}}', rent) AS rent_range FROM f WHERE turn = 1 AND rent BETWEEN 200 AND 50000 AND payload_id % 5 IN (2, 4)""")
def providers(spark, d):
    """Generic bodies whose providers have a reader, none at all, or no data: only unknown names and generic read these."""
    name = F.get(F.array(*map(F.lit, _PROVIDERS)), (F.col("payload_id") % 5).cast("int"))
    found = outcomes.provider_units(orders_as(spark, d, generic_body).withColumn("provider", F.when(F.col("payload_id") % 5 == 0, "wix_nopms").otherwise(name)))
    return found.select("payload_id", "unit_number", "rent_range")


@query("q_x26_body_kinds", """SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'dict (keys: [''k''])' WHEN 1 THEN 'list[dict] (2 items, keys: [''k''])' WHEN 2 THEN 'list (1 items)' WHEN 3 THEN 'str' ELSE 'null' END AS kind,
CASE event_id % 5 WHEN 0 THEN '{k...}' WHEN 1 THEN '[{k...}] (2 items)' WHEN 2 THEN '[...] (1 items)' WHEN 3 THEN left(event_type || repeat('x', 80), 60) ELSE 'null' END AS preview FROM events""")
def body_kinds(spark, d):
    k, p = F.col("event_id") % 5, F.col("props")
    body = F.when(k == 0, p).when(k == 1, F.concat(F.lit("["), p, F.lit(","), p, F.lit("]"))).when(k == 2, F.lit("[5]")).when(k == 3, F.concat(F.lit('"'), "event_type", F.repeat(F.lit("x"), 80), F.lit('"'))).otherwise(F.when(F.col("event_id") % 2 == 0, "null").otherwise("{broken"))
    return table(spark, d, "events").select("event_id", outcomes.body_kind(body).alias("b")).select("event_id", "b.kind", "b.preview")
