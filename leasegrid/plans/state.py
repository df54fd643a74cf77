"""Snapshot state: upsert, diff, carry-forward, sanity, streaks, dedup, merge, duplicates, scheduling, issue stream."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from leasegrid.functions import values as v
from leasegrid.operators import frames
from leasegrid.plans.tables import PROPERTIES, UNITS, properties, snapshot, snapshot_sql, table, units

ALL: dict = {}
BEFORE, AFTER = 1995, 1996
TWO = f"{snapshot_sql('a', BEFORE)}, {snapshot_sql('b', AFTER)}"


def query(name: str, sql: str | None = None):
    return lambda f: ALL.setdefault(name, (f, sql)) and f


@query("q_t02_unit_diff", f"""WITH {TWO} SELECT id, plan, CASE WHEN a.n IS NULL THEN 'new' WHEN b.n IS NULL THEN 'disappeared' WHEN a.asking IS DISTINCT FROM b.asking OR a.n IS DISTINCT FROM b.n THEN 'updated' ELSE 'unchanged' END AS change,
CASE WHEN a.n IS NULL OR b.n IS NULL THEN '' ELSE concat_ws(',', CASE WHEN a.asking IS DISTINCT FROM b.asking THEN 'asking' END, CASE WHEN a.n IS DISTINCT FROM b.n THEN 'n' END) END AS changed,
a.asking AS old_asking, b.asking AS new_asking, a.n AS old_n, b.n AS new_n FROM a FULL JOIN b USING (id, plan)""")
def unit_diff(spark, d):
    return frames.snapshot_diff(snapshot(spark, d, BEFORE), snapshot(spark, d, AFTER), ["id", "plan"], ["asking", "n"])


@query("q_t04_daily_diff", f"""WITH {TWO} SELECT count(*) FILTER (a.n IS NULL) AS new_units, count(*) FILTER (b.n IS NULL) AS gone_units, count(*) FILTER (b.asking - a.asking > 1) AS rent_up, count(*) FILTER (a.asking - b.asking > 1) AS rent_down FROM a FULL JOIN b USING (id, plan)""")
def daily_diff(spark, d):
    x = frames.snapshot_diff(snapshot(spark, d, BEFORE), snapshot(spark, d, AFTER), ["id", "plan"], ["asking"])
    return x.agg(F.count_if(F.col("change") == "new").alias("new_units"), F.count_if(F.col("change") == "disappeared").alias("gone_units"), F.count_if(F.col("new_asking") - F.col("old_asking") > 1).alias("rent_up"), F.count_if(F.col("old_asking") - F.col("new_asking") > 1).alias("rent_down"))


@query("q_t03_carry_forward", f"WITH {TWO} SELECT id, plan, asking, n, 0::BIGINT AS carried FROM b UNION ALL SELECT id, plan, asking, n, 1 FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.id = a.id AND b.plan = a.plan)")
def carry(spark, d):
    return frames.carry_forward(snapshot(spark, d, BEFORE).withColumn("carried", F.lit(0).cast("bigint")), snapshot(spark, d, AFTER), ["id", "plan"])


@query("q_t01_upsert", f"WITH {TWO} SELECT coalesce(b.id, a.id) AS id, coalesce(b.plan, a.plan) AS plan, coalesce(b.asking, a.asking) AS asking, a.id IS NULL AS is_new FROM a FULL JOIN b ON a.id = b.id AND a.plan = b.plan")
def upsert(spark, d):
    a = snapshot(spark, d, BEFORE).select("id", "plan", F.col("asking").alias("old"), F.lit(True).alias("had"))
    return a.join(snapshot(spark, d, AFTER), ["id", "plan"], "full").select("id", "plan", F.coalesce("asking", "old").alias("asking"), F.col("had").isNull().alias("is_new"))


@query("q_j07_prior", "WITH o AS (SELECT o_custkey AS id, year(o_orderdate) AS run, o_totalprice, o_orderkey FROM orders WHERE year(o_orderdate) < 1997) SELECT id, max(run)::INT AS run, max_by(o_orderkey, (run, o_orderkey)) AS unit_id FROM o GROUP BY id")
def prior(spark, d):
    """The latest earlier record of each property, by aggregation instead of a sort."""
    o = units(spark, d).where(F.year("day") < 1997).select("id", F.year("day").alias("run"), "unit_id")
    return frames.latest_by_struct(o, ["id"], ["run", "unit_id"])


@query("q_j10_disappeared", f"WITH {TWO} SELECT id, 'disappeared' AS change FROM (SELECT DISTINCT id FROM a EXCEPT SELECT id FROM b) UNION ALL SELECT id, 'new' FROM (SELECT DISTINCT id FROM b EXCEPT SELECT id FROM a)")
def disappeared(spark, d):
    a, b = snapshot(spark, d, BEFORE).select("id").distinct(), snapshot(spark, d, AFTER).select("id").distinct()
    return a.join(b, "id", "left_anti").select("id", F.lit("disappeared").alias("change")).union(b.join(a, "id", "left_anti").select("id", F.lit("new").alias("change")))


@query("q_v05_sanity", f"WITH {TWO} SELECT id, plan, CASE WHEN abs(b.asking - a.asking) / abs(a.asking) * 100 > 50 THEN 'rent_swing_gt_50pct' ELSE 'rent_swing_gt_20pct' END AS flag FROM a JOIN b USING (id, plan) WHERE a.asking <> 0 AND abs(b.asking - a.asking) / abs(a.asking) * 100 > 20")
def sanity(spark, d):
    a = snapshot(spark, d, BEFORE).select("id", "plan", F.col("asking").alias("old"))
    return snapshot(spark, d, AFTER).join(a, ["id", "plan"]).select("id", "plan", v.swing_flag(F.col("asking"), F.col("old")).alias("flag")).where("flag is not null")


@query("q_t08_drift", "WITH r AS (SELECT o_custkey AS id, year(o_orderdate) AS run, count(*) AS n FROM orders GROUP BY 1, 2), l AS (SELECT *, lag(n) OVER (PARTITION BY id ORDER BY run) AS before FROM r) SELECT id, run::INT AS run, n, before, n < 0.7 * before AS drifted FROM l WHERE before IS NOT NULL")
def drift(spark, d):
    r = units(spark, d).groupBy("id", F.year("day").alias("run")).agg(F.count(F.lit(1)).alias("n"))
    return r.withColumn("before", F.lag("n").over(Window.partitionBy("id").orderBy("run"))).where("before is not null").withColumn("drifted", F.col("n") < 0.7 * F.col("before"))


@query("q_w01_latest", "SELECT user_id, event_id, event_type, ts FROM events WHERE user_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    return frames.latest_by_struct(e, ["user_id"], ["ts", "event_id"])


@query("q_w02_dedup", "SELECT doc_id, text FROM documents WHERE text <> '' QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1")
def dedup(spark, d):
    """First of equal texts. Grouping by a digest keeps texts out of the aggregation's shuffle."""
    docs = table(spark, d, "documents").select("doc_id", "text").where("text <> ''")
    first = docs.groupBy(F.sha2("text", 256).alias("_h")).agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    return docs.join(first, "doc_id", "left_semi")


@query("q_w03_duplicate_position", "WITH l AS (SELECT l_orderkey, l_linenumber, l_suppkey % 3 AS key FROM lineitem), r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, key ORDER BY l_linenumber) AS rn, min(l_linenumber) OVER (PARTITION BY l_orderkey, key) AS first_at FROM l) SELECT l_orderkey, key, first_at, l_linenumber AS again_at FROM r WHERE rn > 1")
def duplicate_position(spark, d):
    by = Window.partitionBy("l_orderkey", "key")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 3).alias("key"))
    r = li.withColumn("rn", F.row_number().over(by.orderBy("l_linenumber"))).withColumn("first_at", F.min("l_linenumber").over(by))
    return r.where("rn > 1").select("l_orderkey", "key", "first_at", F.col("l_linenumber").alias("again_at"))


@query("q_w04_lag", "SELECT conv_id, turn, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations")
def lagged(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", F.lag("role").over(Window.partitionBy("conv_id").orderBy("turn")).alias("before"))


@query("q_w05_streaks", "WITH m AS (SELECT *, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events) SELECT user_id, event_id, (sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, island ORDER BY ts, event_id))::BIGINT AS streak FROM m")
def streaks(spark, d):
    e = table(spark, d, "events")
    return frames.streaks(e, ["user_id"], F.col("event_type") == "error", F.col("ts"), F.col("event_id")).select("user_id", "event_id", "streak")


@query("q_t07_maturity", "SELECT user_id, CASE WHEN count(*) FILTER (event_type = 'error') >= 3 THEN 'COLD' WHEN count(*) FILTER (event_type <> 'error') >= 3 THEN 'HOT' WHEN count(*) FILTER (event_type <> 'error') >= 1 THEN 'WARM' ELSE 'COLD' END AS maturity FROM events GROUP BY 1")
def maturity(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(v.maturity(F.count_if(F.col("event_type") != "error"), F.count_if(F.col("event_type") == "error")).alias("maturity"))


@query("q_w06_round_robin", "SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS turn FROM events")
def round_robin(spark, d):
    return frames.round_robin(table(spark, d, "events"), "user_id", [F.col("ts"), F.col("event_id")]).select("user_id", "event_id", "turn")


@query("q_u04_override_merge", f"WITH {TWO} SELECT * FROM b UNION ALL SELECT * FROM a WHERE id NOT IN (SELECT id FROM b)")
def merge(spark, d):
    return frames.override_merge(snapshot(spark, d, BEFORE), snapshot(spark, d, AFTER), "id")


@query("q_u05_distinct_ordered", "SELECT conv_id, string_agg(role, ',' ORDER BY first_turn) AS roles FROM (SELECT conv_id, role, min(turn) AS first_turn FROM conversations GROUP BY 1, 2) GROUP BY 1")
def distinct_ordered(spark, d):
    """Distinct values in order of first appearance; reduced to one row a value before lists are made."""
    first = table(spark, d, "conversations").groupBy("conv_id", "role").agg(F.min("turn").alias("at"))
    return first.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "role"))), lambda x: x["role"]), ",").alias("roles"))


@query("q_a26_duplicates", f"""WITH {PROPERTIES}, k AS (SELECT id, state || '|' || status AS place, CASE WHEN id % 10 = 0 THEN '' ELSE regexp_replace(name, '[1-9]', '', 'g') END AS web FROM props)
SELECT 'place' AS kind, place AS value, count(DISTINCT id) AS n_ids, count(*) AS n_rows FROM k GROUP BY place HAVING count(DISTINCT id) > 1
UNION ALL SELECT 'web', web, count(DISTINCT id), count(*) FROM k WHERE web <> '' GROUP BY web HAVING count(DISTINCT id) > 1""")
def duplicates(spark, d):
    """Names are read whole; without their digits but 0 some of them are the same."""
    k = properties(spark, d).select("id", F.concat_ws("|", "state", "status").alias("place"), F.when(F.col("id") % 10 == 0, "").otherwise(F.regexp_replace("name", "[1-9]", "")).alias("web"))
    return frames.duplicates(k, "id", ["place", "web"])


@query("q_v01_issues", """SELECT l_orderkey, l_linenumber, 'WARNING' AS severity, 'RENT_OUT_OF_RANGE' AS code FROM lineitem WHERE l_extendedprice NOT BETWEEN 200 AND 50000
UNION ALL SELECT l_orderkey, l_linenumber, 'ERROR', 'BAD_AREA' FROM lineitem WHERE l_quantity < 3 UNION ALL SELECT l_orderkey, l_linenumber, 'WARNING', 'LO_GT_HI' FROM lineitem WHERE l_discount > 0.09""")
def issues(spark, d):
    rules = [("WARNING", "RENT_OUT_OF_RANGE", ~F.col("l_extendedprice").between(v.RENT_LEAST, v.RENT_MOST)), ("ERROR", "BAD_AREA", F.col("l_quantity") < 3), ("WARNING", "LO_GT_HI", F.col("l_discount") > 0.09)]
    return frames.issues(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], rules)


@query("q_a25_issue_summary", """WITH s AS (SELECT 'WARNING' AS severity FROM lineitem WHERE l_extendedprice NOT BETWEEN 200 AND 50000 UNION ALL SELECT 'ERROR' FROM lineitem WHERE l_quantity < 3)
SELECT k AS severity, count(s.severity) AS n FROM (VALUES ('ERROR'), ('WARNING'), ('INFO')) v(k) LEFT JOIN s ON s.severity = k GROUP BY k""")
def issue_summary(spark, d):
    found = frames.issues(table(spark, d, "lineitem"), ["l_orderkey"], [("WARNING", "R", ~F.col("l_extendedprice").between(v.RENT_LEAST, v.RENT_MOST)), ("ERROR", "A", F.col("l_quantity") < 3)])
    n = found.groupBy("severity").agg(F.count(F.lit(1)).alias("n"))
    return spark.createDataFrame([("ERROR",), ("WARNING",), ("INFO",)], "severity string").join(n, "severity", "left").select("severity", F.coalesce("n", F.lit(0)).alias("n"))


@query("q_v06_orchestrate", "WITH r AS (SELECT l_suppkey, count(*) AS n, count(*) FILTER (l_extendedprice > 50000 OR l_quantity < 3) AS rejected FROM lineitem GROUP BY 1) SELECT l_suppkey, n, rejected, rejected / n > 0.5 AS next_tier FROM r")
def orchestrate(spark, d):
    r = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.count_if((F.col("l_extendedprice") > v.RENT_MOST) | (F.col("l_quantity") < 3)).alias("rejected"))
    return r.withColumn("next_tier", F.col("rejected") / F.col("n") > 0.5)


@query("q_x24_tier_cascade", f"WITH {UNITS}, one AS (SELECT DISTINCT id FROM units WHERE plan = '1-URGENT'), two AS (SELECT DISTINCT id FROM units WHERE plan = '2-HIGH') SELECT id, 1 AS tier FROM one UNION ALL SELECT id, 2 FROM two WHERE id NOT IN (SELECT id FROM one)")
def cascade(spark, d):
    u = units(spark, d)
    return frames.tier_cascade([u.where(F.col("plan") == p).select("id").distinct() for p in ("1-URGENT", "2-HIGH")], "id")


@query("q_k09_expiry", "SELECT event_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 3 DAY")
def expiry(spark, d):
    e = table(spark, d, "events")
    return e.crossJoin(F.broadcast(e.agg(F.max("ts").alias("now")))).where(F.col("ts") >= F.col("now") - F.expr("INTERVAL 3 DAYS")).select("event_id")
