"""Further joins, aggregates, decisions and state rules of the reference workload over the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from leasegrid.functions import values as v
from leasegrid.operators import frames
from leasegrid.plans.tables import PROPERTIES, UNITS, properties, snapshot, snapshot_sql, table, units

ALL: dict = {}


def query(name: str, sql: str | None = None):
    return lambda f: ALL.setdefault(name, (f, sql)) and f


def n_rows():
    return F.count(F.lit(1))


@query("q_j11_wasted", f"WITH {PROPERTIES}, {UNITS}, c AS (SELECT user_id AS id, round(sum(value), 4) AS cost, count(*) AS calls FROM events GROUP BY 1) SELECT id, cost, calls FROM c WHERE cost > 0 AND id NOT IN (SELECT id FROM units WHERE asking > 300000)")
def wasted(spark, d):
    """Cost spent on properties without (expensive) units."""
    c = table(spark, d, "events").groupBy(F.col("user_id").alias("id")).agg(F.round(F.sum("value"), 4).alias("cost"), n_rows().alias("calls")).where("cost > 0")
    return c.join(units(spark, d).where("asking > 300000").select("id"), "id", "left_anti")


@query("q_j13_due_first_url", f"WITH {UNITS}, due AS (SELECT DISTINCT user_id AS id FROM events WHERE event_type = 'error') SELECT id, unit_id FROM units WHERE id IN (SELECT id FROM due) QUALIFY row_number() OVER (PARTITION BY id ORDER BY unit_id) = 1")
def due_first(spark, d):
    """The first unit of each property that has a failure."""
    due = table(spark, d, "events").where("event_type = 'error'").select(F.col("user_id").alias("id"))
    return units(spark, d).join(due, "id", "left_semi").groupBy("id").agg(F.min("unit_id").alias("unit_id"))


@query("q_j14_not_parked", f"WITH {PROPERTIES} SELECT id FROM props WHERE id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' GROUP BY 1 HAVING count(*) >= 3)")
def not_parked(spark, d):
    parked = table(spark, d, "events").where("event_type = 'error'").groupBy(F.col("user_id").alias("id")).agg(n_rows().alias("n")).where("n >= 3")
    return properties(spark, d).select("id").join(parked, "id", "left_anti")


@query("q_j16_compare", f"WITH {snapshot_sql('a', 1995)}, {snapshot_sql('b', 1996)} SELECT count(*) FILTER (a.n IS NOT NULL AND b.n IS NOT NULL) AS both_sides, count(*) FILTER (b.n IS NULL) AS only_first, count(*) FILTER (a.n IS NULL) AS only_second, round(avg((a.n = b.n)::INT), 6) AS agreement FROM a FULL JOIN b USING (id, plan)")
def compare(spark, d):
    x = frames.snapshot_diff(snapshot(spark, d, 1995), snapshot(spark, d, 1996), ["id", "plan"], ["n"])
    return x.agg(F.count_if(F.col("change").isin("updated", "unchanged")).alias("both_sides"), F.count_if(F.col("change") == "disappeared").alias("only_first"), F.count_if(F.col("change") == "new").alias("only_second"), F.round(F.avg((F.col("old_n") == F.col("new_n")).cast("int")), 6).alias("agreement"))


@query("q_a02_mix_v2", "SELECT CASE WHEN p_size % 4 = 0 THEN 'Studio' ELSE (p_size % 4) || 'BR' END AS label, count(*) AS n FROM part GROUP BY 1")
def mix_v2(spark, d):
    return table(spark, d, "part").groupBy(v.mix_label(F.col("p_size") % 4).alias("label")).agg(n_rows().alias("n"))


@query("q_a03_avg_area", "SELECT p_type, floor(avg(p_size) FILTER (p_size > 0) + 0.5)::BIGINT AS area FROM part GROUP BY 1")
def avg_area(spark, d):
    return table(spark, d, "part").groupBy("p_type").agg(F.floor(F.avg(F.when(F.col("p_size") > 0, F.col("p_size"))) + 0.5).alias("area"))


@query("q_a09_media", "SELECT regexp_extract(url, '^[^:]+://([^/?#]*)', 1) AS host, min(page_id) AS first_page, count(*) AS n FROM pages GROUP BY 1")
def media(spark, d):
    return table(spark, d, "pages").groupBy(F.regexp_extract("url", "^[^:]+://([^/?#]*)", 1).alias("host")).agg(F.min("page_id").alias("first_page"), n_rows().alias("n"))


@query("q_a17_pms", "SELECT CASE WHEN contains(url, '.org') THEN 'alpha' WHEN contains(url, '.net') THEN 'beta' ELSE 'unknown' END AS pms, count(*) AS n FROM pages GROUP BY 1")
def pms(spark, d):
    kind = F.when(F.col("url").contains(".org"), "alpha").when(F.col("url").contains(".net"), "beta").otherwise("unknown")
    return table(spark, d, "pages").groupBy(kind.alias("pms")).agg(n_rows().alias("n"))


@query("q_a19_distribution", "SELECT event_type, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS pct FROM events GROUP BY 1")
def distribution(spark, d):
    n = table(spark, d, "events").groupBy("event_type").agg(n_rows().alias("n"))
    return n.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 4))


@query("q_a21_maturity_histogram", "WITH m AS (SELECT user_id, count(*) FILTER (event_type = 'error') AS bad, count(*) FILTER (event_type <> 'error') AS ok FROM events GROUP BY 1) SELECT CASE WHEN bad >= 3 THEN 'COLD' WHEN ok >= 3 THEN 'HOT' WHEN ok >= 1 THEN 'WARM' ELSE 'COLD' END AS maturity, count(*) AS n FROM m GROUP BY 1")
def maturity_histogram(spark, d):
    m = table(spark, d, "events").groupBy("user_id").agg(v.maturity(F.count_if(F.col("event_type") != "error"), F.count_if(F.col("event_type") == "error")).alias("maturity"))
    return m.groupBy("maturity").agg(n_rows().alias("n"))


@query("q_a28_cost_block", "WITH c AS (SELECT user_id, sum(value) AS cost FROM events GROUP BY 1) SELECT round(sum(cost), 2) AS total, count(*) AS users, round(avg(cost), 4) AS per_user FROM c WHERE cost > 0")
def cost_block(spark, d):
    c = table(spark, d, "events").groupBy("user_id").agg(F.sum("value").alias("cost")).where("cost > 0")
    return c.agg(F.round(F.sum("cost"), 2).alias("total"), n_rows().alias("users"), F.round(F.avg("cost"), 4).alias("per_user"))


@query("q_a29_confidence", "SELECT doc_id, greatest(0.0, least(1.0, 1.0 - CASE WHEN n_chars < 100 THEN 0.15 ELSE 0 END - CASE WHEN lang <> 'en' THEN 0.05 ELSE 0 END)) AS confidence FROM documents")
def confidence(spark, d):
    lost = F.when(F.col("n_chars") < 100, 0.15).otherwise(0.0) + F.when(F.col("lang") != "en", 0.05).otherwise(0.0)
    return table(spark, d, "documents").select("doc_id", F.round(v.clamp01(1.0 - lost), 10).alias("confidence"))


@query("q_a30_coverage", "SELECT source, round(avg((n_chars > 0)::INT), 6) AS text_share, round(avg((lang = 'en')::INT), 6) AS en_share FROM documents GROUP BY 1")
def coverage(spark, d):
    return table(spark, d, "documents").groupBy("source").agg(F.round(F.avg((F.col("n_chars") > 0).cast("int")), 6).alias("text_share"), F.round(F.avg((F.col("lang") == "en").cast("int")), 6).alias("en_share"))


@query("q_a34_centroid", f"WITH {PROPERTIES} SELECT state, round(avg(balance), 6) AS lat, round(avg(id), 6) AS lng FROM props WHERE balance <> 0 GROUP BY 1")
def centroid(spark, d):
    return properties(spark, d).where("balance <> 0").groupBy("state").agg(F.round(F.avg("balance"), 6).alias("lat"), F.round(F.avg("id"), 6).alias("lng"))


@query("q_a36_starting_price", f"WITH {UNITS} SELECT plan, min(asking) AS starting FROM units WHERE available GROUP BY 1")
def starting(spark, d):
    return units(spark, d).where("available").groupBy("plan").agg(F.min("asking").alias("starting"))


@query("q_o04_top_rent", f"WITH {UNITS} SELECT id, unit_id, asking FROM units ORDER BY asking DESC, unit_id LIMIT 5")
def top_rent(spark, d):
    return frames.top_k(units(spark, d).select("id", "unit_id", "asking"), "asking", 5, "unit_id")


@query("q_o08_payload_rank", "WITH s AS (SELECT event_id, user_id, (contains(lower(props), 'k'))::INT + (contains(props, '9'))::INT + (contains(props, '1'))::INT AS score FROM events) SELECT user_id, event_id, score FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, event_id) <= 3")
def payload_rank(spark, d):
    """The three payloads of each property with most signal words."""
    low = F.lower("props")
    score = sum((low.contains(w).cast("int") for w in ("k", "9", "1")), F.lit(0))
    w = Window.partitionBy("user_id").orderBy(F.desc("score"), "event_id")
    s = table(spark, d, "events").select("user_id", "event_id", score.alias("score")).where("score > 0")
    return s.withColumn("_r", F.row_number().over(w)).where("_r <= 3").drop("_r")


@query("q_o11_recent_runs", "SELECT ts::DATE AS run, count(*) AS n FROM events GROUP BY 1 ORDER BY run DESC LIMIT 30")
def recent_runs(spark, d):
    return table(spark, d, "events").groupBy(F.to_date("ts").alias("run")).agg(n_rows().alias("n")).orderBy(F.desc("run")).limit(30)


@query("q_u01_union_drift", "SELECT n_nationkey AS id, n_name AS name, n_regionkey AS parent FROM nation UNION ALL SELECT r_regionkey, r_name, NULL FROM region")
def union_drift(spark, d):
    a = table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("parent"))
    return a.unionByName(table(spark, d, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")), allowMissingColumns=True)


@query("q_f13_range_text", "SELECT l_orderkey, l_linenumber, '$' || format('{:,}', floor(l_extendedprice * 0.9)::BIGINT) || ' - $' || format('{:,}', floor(l_extendedprice)::BIGINT) AS rent_range FROM lineitem WHERE l_extendedprice >= 100")
def range_text(spark, d):
    li = table(spark, d, "lineitem").where("l_extendedprice >= 100")
    return li.select("l_orderkey", "l_linenumber", v.rent_range_text(F.floor(F.col("l_extendedprice") * 0.9), F.floor("l_extendedprice")).alias("rent_range"))


@query("q_f17_rent_value", "SELECT c_custkey, CASE WHEN c_acctbal > 1 THEN c_acctbal END AS rent FROM customer")
def rent_value(spark, d):
    return table(spark, d, "customer").select("c_custkey", v.rent_value(F.concat(F.lit("$"), F.format_number("c_acctbal", 2))).alias("rent"))


@query("q_f21_lease_term", "SELECT p_partkey, CASE WHEN p_size > 1 THEN p_size END AS term FROM part")
def lease_term(spark, d):
    return table(spark, d, "part").select("p_partkey", v.lease_term(F.col("p_size").cast("string")).alias("term"))


@query("q_f29_llm_cost", "SELECT e.event_id, round((e.event_id % 1000 * coalesce(p.i, 0.15) + e.user_id % 500 * coalesce(p.o, 0.6)) / 1e6, 8) AS cost FROM events e LEFT JOIN (VALUES ('click', 0.15, 0.6), ('error', 2.5, 10.0)) p(m, i, o) ON e.event_type = p.m")
def llm_cost(spark, d):
    """Prices are data: a small table of known size, broadcast. Models without a price have the default one."""
    prices = spark.createDataFrame([("click", 0.15, 0.6), ("error", 2.5, 10.0)], "event_type string, i double, o double")
    e = table(spark, d, "events").join(F.broadcast(prices), "event_type", "left")
    return e.select("event_id", F.round((F.col("event_id") % 1000 * F.coalesce("i", F.lit(0.15)) + F.col("user_id") % 500 * F.coalesce("o", F.lit(0.6))) / 1e6, 8).alias("cost"))


@query("q_f30_backoff", "SELECT event_id, 1000 * pow(2, event_id % 5)::BIGINT AS delay_ms FROM events")
def backoff(spark, d):
    return table(spark, d, "events").select("event_id", v.retry_delay_ms(F.col("event_id") % 5 + 1).cast("bigint").alias("delay_ms"))


@query("q_f32_fetch_mode", "SELECT o_orderkey, CASE WHEN date_diff('day', o_orderdate::DATE, DATE '1998-08-01') > 1000 THEN 'RENDER' WHEN o_orderpriority = '1-URGENT' THEN 'GET' WHEN o_orderpriority = '2-HIGH' THEN 'GET' ELSE 'RENDER' END AS mode FROM orders")
def fetch_mode(spark, d):
    age = F.datediff(F.lit("1998-08-01").cast("date"), F.to_date("o_orderdate"))
    mode = F.when(age > 1000, "RENDER").when(F.col("o_orderpriority") == "1-URGENT", "GET").when(F.col("o_orderpriority") == "2-HIGH", "GET").otherwise("RENDER")
    return table(spark, d, "orders").select("o_orderkey", mode.alias("mode"))


@query("q_f33_carry_decision", "SELECT event_id, event_type = 'error' OR value IS NULL OR value < 5 AS carry, CASE WHEN event_type = 'error' THEN 'fetch_failed' WHEN value IS NULL THEN 'no_result' WHEN value < 5 THEN 'empty_units' ELSE '' END AS reason FROM events")
def carry_decision(spark, d):
    reason = F.when(F.col("event_type") == "error", "fetch_failed").when(F.col("value").isNull(), "no_result").when(F.col("value") < 5, "empty_units").otherwise("")
    return table(spark, d, "events").select("event_id", (reason != "").alias("carry"), reason.alias("reason"))


@query("q_f34_verdict", "WITH r AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_quantity < 10) AS rejected FROM lineitem GROUP BY 1) SELECT l_orderkey, CASE WHEN n = 0 THEN 'FAILED_NO_DATA' WHEN rejected / n > 0.5 THEN 'PARTIAL' ELSE 'SUCCESS' END AS verdict FROM r")
def verdict(spark, d):
    r = table(spark, d, "lineitem").groupBy("l_orderkey").agg(n_rows().alias("n"), F.count_if(F.col("l_quantity") < 10).alias("rejected"))
    return r.select("l_orderkey", F.when(F.col("n") == 0, "FAILED_NO_DATA").when(F.col("rejected") / F.col("n") > 0.5, "PARTIAL").otherwise("SUCCESS").alias("verdict"))


@query("q_f40_format", "SELECT c_custkey, left(c_name, 10) || CASE WHEN length(c_name) > 10 THEN '...' ELSE '' END AS short_name, regexp_replace(c_name, '[^A-Za-z0-9._-]+', '_', 'g') AS file_name FROM customer")
def formats(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.concat(F.substring("c_name", 1, 10), F.when(F.length("c_name") > 10, "...").otherwise("")).alias("short_name"), F.regexp_replace("c_name", "[^A-Za-z0-9._-]+", "_").alias("file_name"))


@query("q_f42_mask", "SELECT page_id, replace(url, '://', '://***@') AS masked FROM pages")
def mask(spark, d):
    """Pages' URLs get credentials first, so that masking has something to hide."""
    made = F.regexp_replace("url", "://", "://user:secret@")
    return table(spark, d, "pages").select("page_id", v.mask_credentials(made).alias("masked"))


@query("q_v04_schema_gate", "SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN l_extendedprice > 50000 THEN 'rent' END, CASE WHEN l_quantity > 45 THEN 'sqft' END) AS reasons FROM lineitem WHERE l_extendedprice > 50000 OR l_quantity > 45")
def schema_gate(spark, d):
    reasons = F.concat_ws(",", F.when(F.col("l_extendedprice") > 50_000, "rent"), F.when(F.col("l_quantity") > 45, "sqft"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", reasons.alias("reasons")).where("reasons <> ''")


@query("q_t05_failure_streak_now", "WITH m AS (SELECT user_id, event_id, event_type, ts, max(CASE WHEN event_type <> 'error' THEN ts END) OVER (PARTITION BY user_id) AS last_ok FROM events) SELECT user_id, count(*) FILTER (event_type = 'error' AND (last_ok IS NULL OR ts > last_ok)) AS streak FROM m GROUP BY 1")
def streak_now(spark, d):
    """Failures since the last success, by two aggregations and no sort."""
    e = table(spark, d, "events").select("user_id", "event_type", "ts")
    ok = e.where("event_type <> 'error'").groupBy("user_id").agg(F.max("ts").alias("last_ok"))
    return e.join(ok, "user_id", "left").groupBy("user_id").agg(F.count_if((F.col("event_type") == "error") & (F.col("last_ok").isNull() | (F.col("ts") > F.col("last_ok")))).alias("streak"))


@query("q_t06_dlq_due", "WITH l AS (SELECT user_id, max_by(event_type, (ts, event_id)) AS last_type, max(ts) AS last_ts FROM events GROUP BY 1) SELECT user_id, CASE WHEN last_ts > TIMESTAMP '2024-01-05' THEN last_ts + INTERVAL 1 HOUR ELSE last_ts + INTERVAL 1 DAY END AS retry_at FROM l WHERE last_type = 'error'")
def dlq_due(spark, d):
    last = frames.latest_by_struct(table(spark, d, "events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"])
    retry = F.when(F.col("ts") > F.lit("2024-01-05").cast("timestamp_ntz"), F.col("ts") + F.expr("INTERVAL 1 HOUR")).otherwise(F.col("ts") + F.expr("INTERVAL 1 DAY"))
    return last.where("event_type = 'error'").select("user_id", retry.alias("retry_at"))


@query("q_t10_change_detection", "SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'CHANGED' WHEN (event_id % 2 = 0 OR event_id % 3 = 0) AND (event_id % 2 <> 1 OR event_id % 3 = 0) THEN 'UNCHANGED' ELSE 'CHANGED' END AS state FROM events")
def change_detection(spark, d):
    """UNCHANGED only if there is a conclusive probe and every conclusive one agrees; null probes tell nothing."""
    i = F.col("event_id")
    probes = F.array(F.when(i % 2 == 0, True), F.when(i % 3 == 0, True), F.when((i % 2 == 1) & (i % 3 != 0), False))
    told = F.filter(probes, lambda x: x.isNotNull())
    same = (F.size(told) > 0) & F.forall(told, lambda x: x)
    return table(spark, d, "events").select("event_id", F.when(i % 7 == 0, "CHANGED").when(same, "UNCHANGED").otherwise("CHANGED").alias("state"))


@query("q_t13_schedule", f"WITH {PROPERTIES}, e AS (SELECT user_id AS id, count(*) FILTER (event_type = 'error') AS bad FROM events GROUP BY 1) SELECT p.id, p.city AS host, CASE WHEN bad >= 3 THEN 0 WHEN bad IS NULL THEN 1 ELSE 2 END AS level, row_number() OVER (PARTITION BY p.city, CASE WHEN bad >= 3 THEN 0 WHEN bad IS NULL THEN 1 ELSE 2 END ORDER BY p.id) AS turn FROM props p LEFT JOIN e USING (id)")
def schedule(spark, d):
    bad = table(spark, d, "events").groupBy(F.col("user_id").alias("id")).agg(F.count_if(F.col("event_type") == "error").alias("bad"))
    level = F.when(F.col("bad") >= 3, 0).when(F.col("bad").isNull(), 1).otherwise(2)
    p = properties(spark, d).join(bad, "id", "left").select("id", F.col("city").alias("host"), level.alias("level"))
    return p.withColumn("turn", F.row_number().over(Window.partitionBy("host", "level").orderBy("id")))


@query("q_p17_retry", "SELECT event_id FROM events WHERE contains(upper(event_type), 'ERR') OR value IS NULL OR value < 1")
def retry(spark, d):
    return table(spark, d, "events").where(F.upper("event_type").contains("ERR") | F.col("value").isNull() | (F.col("value") < 1)).select("event_id")


@query("q_p22_veto", "SELECT l_orderkey, count(*) AS n, count(*) < greatest(1, floor(0.2 * 20)::INT) AND bool_and(l_extendedprice < 30000) AS veto FROM lineitem GROUP BY 1")
def veto(spark, d):
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(n_rows().alias("n"), ((n_rows() < 4) & F.bool_and(F.col("l_extendedprice") < 30_000)).alias("veto"))


@query("q_p24_blocklist", "SELECT page_id FROM pages WHERE NOT (contains(url, 'blog.') OR contains(url, '?page='))")
def blocklist(spark, d):
    return table(spark, d, "pages").where(~(F.col("url").contains("blog.") | F.col("url").contains("?page="))).select("page_id")
