"""Event, cost, SLO, run and health analytics over the event ledger."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from leasegrid.functions import values as v
from leasegrid.operators import rolling as rolling_operators
from leasegrid.plans.tables import table

ALL: dict = {}


def query(name: str, sql: str | None = None):
    return lambda f: ALL.setdefault(name, (f, sql)) and f


def events(spark, d):
    return table(spark, d, "events")


def n_rows():
    return F.count(F.lit(1))


@query("q_a10_tier_histogram", "SELECT event_type, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM events GROUP BY event_type")
def tier_histogram(spark, d):
    n = events(spark, d).groupBy("event_type").agg(n_rows().alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


@query("q_a11_run_totals", "SELECT ts::DATE AS day, count(*) AS total, count(*) FILTER (event_type = 'error') AS failed, round(100.0 * count(*) FILTER (event_type <> 'error') / count(*), 2) AS success_pct FROM events GROUP BY 1")
def run_totals(spark, d):
    return events(spark, d).groupBy(F.to_date("ts").alias("day")).agg(n_rows().alias("total"), F.count_if(F.col("event_type") == "error").alias("failed"), F.round(100.0 * F.count_if(F.col("event_type") != "error") / n_rows(), 2).alias("success_pct"))


@query("q_a12_slo", """WITH m AS (SELECT ts::DATE AS day, count(*) FILTER (event_type <> 'error') / count(*) AS success, sum(value) AS cost, count(*) FILTER (event_type = 'click') / count(*) AS vision FROM events GROUP BY 1)
SELECT day, 'success_rate' AS metric, round(success, 6) AS value, 0.95 AS target FROM m WHERE success < 0.95
UNION ALL SELECT day, 'cost', round(cost, 4), 1.0 FROM m WHERE cost > 1.0
UNION ALL SELECT day, 'vision_share', round(vision, 6), 0.05 FROM m WHERE vision > 0.05""")
def slo(spark, d):
    """Breached objectives of each day, one row each."""
    m = events(spark, d).groupBy(F.to_date("ts").alias("day")).agg((F.count_if(F.col("event_type") != "error") / n_rows()).alias("success"), F.sum("value").alias("cost"), (F.count_if(F.col("event_type") == "click") / n_rows()).alias("vision"))
    one = lambda name, value, digits, target, bad: F.struct(F.lit(name).alias("metric"), F.round(value, digits).alias("value"), F.lit(target).alias("target"), bad.alias("bad"))
    rows = m.select("day", F.explode(F.array(one("success_rate", F.col("success"), 6, 0.95, F.col("success") < 0.95), one("cost", F.col("cost"), 4, 1.0, F.col("cost") > 1.0), one("vision_share", F.col("vision"), 6, 0.05, F.col("vision") > 0.05))).alias("m"))
    return rows.where("m.bad").select("day", "m.metric", "m.value", "m.target")


@query("q_a13_cost_rollup", "SELECT user_id % 7 AS pms, event_type AS category, round(sum(value), 4) AS cost, count(*) AS n FROM events GROUP BY 1, 2 HAVING sum(value) > 0")
def cost_rollup(spark, d):
    return events(spark, d).groupBy((F.col("user_id") % 7).alias("pms"), F.col("event_type").alias("category")).agg(F.round(F.sum("value"), 4).alias("cost"), n_rows().alias("n"), F.sum("value").alias("_raw")).where("_raw > 0").drop("_raw")


@query("q_a13_pivot", "SELECT user_id % 7 AS pms, round(coalesce(sum(value) FILTER (event_type = 'click'), 0), 4) AS click, round(coalesce(sum(value) FILTER (event_type = 'error'), 0), 4) AS error FROM events GROUP BY 1")
def cost_pivot(spark, d):
    p = events(spark, d).groupBy((F.col("user_id") % 7).alias("pms")).pivot("event_type", ["click", "error"]).agg(F.sum("value"))
    return p.select("pms", *[F.round(F.coalesce(c, F.lit(0.0)), 4).alias(c) for c in ("click", "error")])


@query("q_a14_run_summary", "SELECT ts::DATE AS day, count(*) AS calls, count(DISTINCT user_id) AS properties, round(sum(value), 4) AS cost FROM events GROUP BY 1")
def run_summary(spark, d):
    return events(spark, d).groupBy(F.to_date("ts").alias("day")).agg(n_rows().alias("calls"), F.countDistinct("user_id").alias("properties"), F.round(F.sum("value"), 4).alias("cost"))


@query("q_a15_grouping_sets", """SELECT CASE WHEN grouping(event_type) = 0 THEN 'tier' WHEN grouping(user_id % 5) = 0 THEN 'provider' ELSE 'model' END AS what,
coalesce(event_type, (user_id % 5)::VARCHAR, (event_id % 3)::VARCHAR) AS value, count(*) AS calls, round(sum(value), 4) AS cost FROM events
GROUP BY GROUPING SETS ((event_type), (user_id % 5), (event_id % 3))""")
def grouping_sets(spark, d):
    e = events(spark, d).select("event_type", (F.col("user_id") % 5).cast("string").alias("provider"), (F.col("event_id") % 3).cast("string").alias("model"), "value")
    g = e.groupingSets([("event_type",), ("provider",), ("model",)], "event_type", "provider", "model").agg(n_rows().alias("calls"), F.round(F.sum("value"), 4).alias("cost"), F.grouping_id().alias("g"))
    return g.select(F.when(F.col("g") == 3, "tier").when(F.col("g") == 5, "provider").otherwise("model").alias("what"), F.coalesce("event_type", "provider", "model").alias("value"), "calls", "cost")


@query("q_a16_per_property", "SELECT user_id, count(*) AS calls, count(*) FILTER (event_type <> 'error') AS ok, round(sum(value), 4) AS cost, max(ts) AS last_ts FROM events GROUP BY 1")
def per_property(spark, d):
    return events(spark, d).groupBy("user_id").agg(n_rows().alias("calls"), F.count_if(F.col("event_type") != "error").alias("ok"), F.round(F.sum("value"), 4).alias("cost"), F.max("ts").alias("last_ts"))


@query("q_a18_classes", "SELECT CASE WHEN event_type = 'error' THEN 'failed' WHEN value IS NULL THEN 'empty' WHEN value > 10 THEN 'ok' ELSE 'carried' END AS class, count(*) AS n FROM events GROUP BY 1")
def classes(spark, d):
    c = F.when(F.col("event_type") == "error", "failed").when(F.col("value").isNull(), "empty").when(F.col("value") > 10, "ok").otherwise("carried")
    return events(spark, d).groupBy(c.alias("class")).agg(n_rows().alias("n"))


@query("q_a20_signatures", """WITH s AS (SELECT left(props, 80) AS signature, event_id FROM events WHERE event_type = 'error'), r AS (SELECT *, row_number() OVER (PARTITION BY signature ORDER BY event_id) AS rn FROM s)
SELECT signature, count(*) AS n, string_agg(event_id::VARCHAR, ',' ORDER BY event_id) FILTER (rn <= 5) AS sample FROM r GROUP BY signature""")
def signatures(spark, d):
    """Failure signatures with their first five ids; ids are ranked before they are gathered, so lists stay short."""
    s = events(spark, d).where("event_type = 'error'").select(F.substring("props", 1, 80).alias("signature"), "event_id")
    n = s.groupBy("signature").agg(n_rows().alias("n"))
    first = s.withColumn("rn", F.row_number().over(Window.partitionBy("signature").orderBy("event_id"))).where("rn <= 5").groupBy("signature").agg(F.sort_array(F.collect_list("event_id")).alias("ids"))
    return n.join(first, "signature").select("signature", "n", F.array_join(F.col("ids").cast("array<string>"), ",").alias("sample"))


@query("q_a24_trailing", "WITH m AS (SELECT max(ts) AS now FROM events) SELECT user_id % 50 AS domain, count(*) FILTER (ts > now - INTERVAL 1 DAY) AS n_24h, count(*) AS n_7d, round(count(*) FILTER (event_type = 'error') / count(*), 6) AS failure_rate FROM events, m WHERE ts > now - INTERVAL 7 DAY GROUP BY 1 HAVING count(*) FILTER (event_type = 'error') / count(*) > 0.05")
def trailing(spark, d):
    """The newest timestamp is one row, joined as such."""
    e = events(spark, d)
    rows = e.crossJoin(F.broadcast(e.agg(F.max("ts").alias("now")))).where(F.col("ts") > F.col("now") - F.expr("INTERVAL 7 DAYS"))
    rate = F.count_if(F.col("event_type") == "error") / n_rows()
    return rows.groupBy((F.col("user_id") % 50).alias("domain")).agg(F.count_if(F.col("ts") > F.col("now") - F.expr("INTERVAL 1 DAY")).alias("n_24h"), n_rows().alias("n_7d"), F.round(rate, 6).alias("failure_rate"), rate.alias("_r")).where("_r > 0.05").drop("_r")


@query("q_a33_health", "WITH m AS (SELECT ts::DATE AS day, count(*) FILTER (event_type <> 'error') / count(*) AS rate, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1) SELECT day, round(rate, 6) AS rate, errors, concat_ws(',', CASE WHEN rate < 0.95 THEN 'LOW_SUCCESS_RATE' END, CASE WHEN errors > 10 THEN 'HIGH_ERROR_COUNT' END) AS alerts FROM m")
def health(spark, d):
    m = events(spark, d).groupBy(F.to_date("ts").alias("day")).agg((F.count_if(F.col("event_type") != "error") / n_rows()).alias("rate"), F.count_if(F.col("event_type") == "error").alias("errors"))
    return m.select("day", F.round("rate", 6).alias("rate"), "errors", F.concat_ws(",", F.when(F.col("rate") < 0.95, "LOW_SUCCESS_RATE"), F.when(F.col("errors") > 10, "HIGH_ERROR_COUNT")).alias("alerts"))


@query("q_a31_agreement", "SELECT source, count(*) AS comparisons, count(*) FILTER (quality = (n_chars > 100)::INT) AS agree, round(count(*) FILTER (quality = (n_chars > 100)::INT) / count(*), 6) AS rate FROM documents JOIN labels USING (doc_id) GROUP BY source")
def agreement(spark, d):
    both = table(spark, d, "documents").select("doc_id", "source", "n_chars").join(table(spark, d, "labels"), "doc_id")
    same = F.col("quality") == (F.col("n_chars") > 100).cast("int")
    return both.groupBy("source").agg(n_rows().alias("comparisons"), F.count_if(same).alias("agree"), F.round(F.count_if(same) / n_rows(), 6).alias("rate"))


@query("q_a35_consensus", "WITH s AS (SELECT user_id, event_type, sum(value) AS total, max(value) AS top, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(total, 6) DESC, event_type) AS rn FROM s) SELECT user_id, event_type AS winner, n, round(least(0.95, top / 1000 + 0.10 * (n - 1)), 6) AS confidence FROM r WHERE rn = 1")
def consensus(spark, d):
    s = events(spark, d).where("value is not null").groupBy("user_id", "event_type").agg(F.sum("value").alias("total"), F.max("value").alias("top"), n_rows().alias("n"))
    best = Window.partitionBy("user_id").orderBy(F.round("total", 6).desc(), "event_type")
    return s.withColumn("rn", F.row_number().over(best)).where("rn = 1").select("user_id", F.col("event_type").alias("winner"), "n", F.round(F.least(F.lit(0.95), F.col("top") / 1000 + 0.10 * (F.col("n") - 1)), 6).alias("confidence"))


@query("q_a37_best_endpoint", "WITH s AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS rn FROM s) SELECT user_id, event_type, n FROM r WHERE rn = 1")
def best_endpoint(spark, d):
    s = events(spark, d).groupBy("user_id", "event_type").agg(n_rows().alias("n"))
    best = s.groupBy("user_id").agg(F.min(F.struct(-F.col("n"), F.col("event_type"), F.col("n").alias("count"))).alias("r"))
    return best.select("user_id", "r.event_type", F.col("r.count").alias("n"))


@query("q_t09_windows", "WITH w AS (SELECT event_type, value, unnest(range(0, 7)) AS k, ts FROM events) SELECT event_type, ts::DATE - k::INT AS first_day, count(*) AS n, round(sum(value), 4) AS total FROM w GROUP BY 1, 2")
def windows(spark, d):
    """Seven-day windows that slide by a day."""
    w = events(spark, d).groupBy(F.window("ts", "7 days", "1 day"), "event_type").agg(n_rows().alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return w.select("event_type", F.to_date("window.start").alias("first_day"), "n", "total")


@query("q_w07_rolling_7d", "WITH r AS (SELECT event_id, user_id % 50 AS domain, count(*) OVER w AS n, count(*) FILTER (event_type = 'error') OVER w AS errors FROM events WINDOW w AS (PARTITION BY user_id % 50 ORDER BY floor(epoch(ts))::BIGINT RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW)) SELECT event_id, domain, n, round(errors / n, 6) AS rate FROM r")
def rolling(spark, d):
    """Events are counted by second before the windows, so a domain's rows never meet in one task."""
    e = events(spark, d).select("event_id", (F.col("user_id") % 50).alias("domain"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("s"), (F.col("event_type") == "error").alias("bad"))
    found = rolling_operators.rolling_failures(e, "domain", "s", "bad", span=604_800, threshold=1.0)
    return found.select("event_id", "domain", "n", F.round(F.col("errors") / F.col("n"), 6).alias("rate"))
