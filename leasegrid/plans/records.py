"""Records, gates, schedules and costs in full, over the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from leasegrid.functions import values as v
from leasegrid.operators import frames
from leasegrid.operators import records as r
from leasegrid.plans.tables import PROPERTIES, properties, table

ALL: dict = {}
CAPTURED = "2024-01-01 00:00:00"


def query(name: str, sql: str | None = None):
    return lambda f: ALL.setdefault(name, (f, sql)) and f


# Line items as raw units: some without id, rents or a plan; rents as numbers or only as a text of a range.
RAW_UNITS = """raw AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 > 0 THEN l_orderkey || '-' || l_linenumber END AS unit_id, CASE WHEN l_linenumber % 3 = 0 AND l_quantity > 10 THEN 'N' || l_quantity::INT END AS unit_number,
  CASE WHEN l_quantity % 5 = 0 THEN 'Studio' WHEN l_quantity % 5 < 4 THEN (l_quantity % 5)::INT::VARCHAR END AS bedrooms, (l_discount * 25)::DECIMAL(6, 2)::VARCHAR AS bathrooms, CASE WHEN l_returnflag <> 'R' THEN 'Plan ' || l_returnflag END AS floor_plan_name,
  (l_quantity::INT * 30)::VARCHAR AS sqft, CASE WHEN l_linestatus = 'O' THEN (floor(l_extendedprice) / 10)::DECIMAL(12, 1)::VARCHAR END AS market_rent_low, CASE WHEN l_linestatus = 'F' AND l_linenumber > 2 THEN floor(l_extendedprice)::BIGINT::VARCHAR END AS asking_rent,
  '$' || (1000 + l_linenumber) || ' - $' || (2000 + l_linenumber) AS rent_range, CASE WHEN l_tax > 0.06 THEN strftime(l_shipdate, '%m/%d/%Y') ELSE strftime(l_shipdate, '%Y-%m-%d') END AS available_date, l_linenumber::VARCHAR AS lease_term, l_extendedprice, l_quantity, l_tax, l_returnflag FROM lineitem)"""


def raw_units(spark, d):
    text = lambda c: c.cast("string")
    q, n = F.col("l_quantity"), F.col("l_linenumber")
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(n % 3 > 0, F.concat_ws("-", "l_orderkey", "l_linenumber")).alias("unit_id"), F.when((n % 3 == 0) & (q > 10), F.concat(F.lit("N"), text(q.cast("int")))).alias("unit_number"),
        F.when(q % 5 == 0, "Studio").when(q % 5 < 4, text((q % 5).cast("int"))).alias("bedrooms"), text((F.col("l_discount") * 25).cast("decimal(6,2)")).alias("bathrooms"),
        F.when(F.col("l_returnflag") != "R", F.concat(F.lit("Plan "), F.col("l_returnflag"))).alias("floor_plan_name"), text(q.cast("int") * 30).alias("sqft"),
        F.when(F.col("l_linestatus") == "O", text((F.floor("l_extendedprice") / 10).cast("decimal(12,1)"))).alias("market_rent_low"),
        F.when((F.col("l_linestatus") == "F") & (n > 2), text(F.floor("l_extendedprice"))).alias("asking_rent"),
        F.concat(F.lit("$"), 1000 + n, F.lit(" - $"), 2000 + n).alias("rent_range"),
        F.when(F.col("l_tax") > 0.06, F.date_format("l_shipdate", "MM/dd/yyyy")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("available_date"), text(n).alias("lease_term"),
        "l_extendedprice", "l_quantity", "l_tax", "l_returnflag",
    )


@query("q_p05_unit_v2", f"""WITH {RAW_UNITS}, u AS (SELECT *, coalesce(market_rent_low, asking_rent) AS lo, asking_rent AS hi FROM raw)
SELECT l_orderkey, l_linenumber, CASE WHEN bedrooms = 'Studio' THEN 0 ELSE bedrooms::INT END AS beds, round_even(bathrooms::DOUBLE * 2, 0) / 2 AS baths, floor_plan_name,
  CASE WHEN sqft::INT BETWEEN 150 AND 10000 THEN sqft::INT ELSE -1 END AS area, coalesce(unit_id, unit_number) AS unit_id, CASE WHEN lo IS NULL AND hi IS NULL THEN 1000 + l_linenumber ELSE nullif(lo::DOUBLE, 0) END::DOUBLE AS rent_low,
  CASE WHEN lo IS NULL AND hi IS NULL THEN 2000 + l_linenumber ELSE hi::DOUBLE END::DOUBLE AS rent_high,
  CASE WHEN available_date LIKE '%/%' THEN right(available_date, 4) || '-' || left(available_date, 2) || '-' || substr(available_date, 4, 2) ELSE available_date END AS available_date, CASE WHEN l_linenumber > 1 THEN l_linenumber END AS lease_term FROM u""")
def unit_v2(spark, d):
    u = raw_units(spark, d)
    return u.withColumn("unit", r.unit_v2(u, F.lit(CAPTURED))).select("l_orderkey", "l_linenumber", *[f"unit.{c}" for c in ("beds", "baths", "floor_plan_name", "area", "unit_id", "rent_low", "rent_high", "available_date", "lease_term")])


# Properties as the owner's file and as the page has them.
FOUND = """found AS (SELECT id, CASE WHEN id % 4 = 0 THEN 'None' WHEN id % 4 = 1 THEN '' ELSE name END AS file_name, CASE WHEN id % 8 <> 1 THEN upper(name) END AS page_name, city, state, CASE WHEN id % 3 = 0 THEN id::VARCHAR WHEN id % 3 = 1 THEN 'x' END AS zip,
  CASE WHEN id % 5 = 0 THEN 'Yardi' WHEN id % 5 = 1 THEN 'other' WHEN id % 5 = 2 THEN '' END AS platform, status FROM props)"""


def found(spark, d):
    k = F.col("id")
    return properties(spark, d).select(
        "id", F.when(k % 4 == 0, "None").when(k % 4 == 1, "").otherwise(F.col("name")).alias("name"), F.when(k % 8 != 1, F.upper("name")).alias("md_name"), "city", "state",
        F.when(k % 3 == 0, k.cast("string")).when(k % 3 == 1, "x").alias("zip"), F.when(k % 5 == 0, "Yardi").when(k % 5 == 1, "other").when(k % 5 == 2, "").alias("platform_detected"), "status",
    )


@query("q_p04_record_v2", f"""WITH {PROPERTIES}, {FOUND}, n AS (SELECT o_custkey AS id, count(*) AS n, sum(floor(o_totalprice)) AS total FROM orders GROUP BY 1)
SELECT id, id AS apartment_id, coalesce(CASE WHEN file_name NOT IN ('', 'None') THEN file_name END, page_name) AS proj_name, city, state, CASE WHEN id % 3 = 0 THEN CASE WHEN id >= 10000 THEN left(id::VARCHAR, 5) ELSE lpad(id::VARCHAR, 5, '0') END END AS zip_code,
  CASE id % 5 WHEN 0 THEN 'Powered by RentCafe (Yardi)' WHEN 1 THEN 'other' END AS website_design, coalesce(n.n, 0)::INT AS n_units, coalesce(total, 0)::DOUBLE AS rents FROM found LEFT JOIN n USING (id)""")
def record_v2(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("unit_number"), F.floor("o_totalprice").alias("asking_rent"))
    out = r.record_v2(found(spark, d), o.select("id", r.unit_v2(o, F.lit(CAPTURED)).alias("unit")), "id")
    units = F.coalesce("units", F.array().cast(out.schema["units"].dataType))
    return out.select("id", "apartment_id", "proj_name", "city", "state", "zip_code", "website_design", F.size(units).alias("n_units"), F.aggregate(units, F.lit(0.0), lambda s, u: s + u["rent_low"]).alias("rents"))


@query("q_p03_record_v1", f"""WITH {PROPERTIES}, {FOUND}, n AS (SELECT o_custkey AS id, count(*) AS n, min(o_orderdate)::DATE::VARCHAR AS first_day FROM orders GROUP BY 1)
SELECT id, id::VARCHAR AS unique_id, coalesce(CASE WHEN file_name NOT IN ('', 'None') THEN file_name END, page_name) AS property_name, status AS property_status, city, coalesce(n.n, CASE WHEN id % 2 = 1 THEN 7 END)::DOUBLE AS total_units,
  coalesce(first_day, '2020-01-01') AS first_move_in, '2024-01-01' AS update_date, 40::INT AS n_fields FROM found LEFT JOIN n USING (id)""")
def record_v1(spark, d):
    """The file gives unit counts for every other property; what the run's units come to wins."""
    o = table(spark, d, "orders")
    stats = o.groupBy(F.col("o_custkey").alias("id")).agg(F.count(F.lit(1)).alias("total_units"), F.min(F.to_date("o_orderdate")).cast("string").alias("first_move_in"))
    file = found(spark, d).withColumnsRenamed({"name": "Property Name", "city": "City", "state": "State", "zip": "ZIP Code", "status": "Property Status"})
    file = file.withColumns({"canonical_id": F.col("id").cast("string"), "Total Units": F.when(F.col("id") % 2 == 1, 7), "First Move-In Date": F.lit("2020-01-01")})
    out = r.record_v1(file, stats, "id", F.lit("2024-01-01"))
    n = len([c for c in r.public_columns(out).columns if c != "id"]) + 1
    return out.select("id", F.col("Unique ID").alias("unique_id"), F.col("Property Name").alias("property_name"), F.col("Property Status").alias("property_status"), F.col("City").alias("city"), F.col("Total Units").alias("total_units"), F.col("First Move-In Date").alias("first_move_in"), F.col("Update Date").alias("update_date"), F.lit(n).alias("n_fields"))


@query("q_x34_failed", """SELECT event_id, user_id AS apartment_id, 'https://p' || user_id || '.example' AS website, 'FAILED' AS tier, props AS error, NULL::VARCHAR AS proj_name, 0::INT AS n_units FROM events WHERE event_type = 'error'""")
def failed(spark, d):
    e = table(spark, d, "events").where("event_type = 'error'").select("event_id", F.struct(F.col("user_id"), F.concat(F.lit("https://p"), F.col("user_id"), F.lit(".example")).alias("url"), F.col("props")).alias("e"))
    out = r.failed_records(e.select("event_id", "e.*").withColumn("props", F.concat_ws("\x1f", "event_id", "props")), "user_id", "url", "props", 2)
    why = F.split(F.element_at("_meta.scrape_errors", 1), "\x1f")
    return out.select(why[0].cast("long").alias("event_id"), "apartment_id", "website", F.col("_meta.scrape_tier_used").alias("tier"), why[1].alias("error"), "proj_name", F.size("units").alias("n_units"))


_GATED = f"""WITH {RAW_UNITS}, u AS (SELECT *, CASE WHEN l_tax = 0.02 THEN '-' ELSE '' END || l_extendedprice::DECIMAL(12, 2) AS rent, CASE WHEN l_quantity = 7 THEN 'n/a' WHEN l_quantity = 8 THEN '-5' WHEN l_quantity = 9 THEN '20001' ELSE sqft END AS s FROM raw),
g AS (SELECT l_orderkey, l_linenumber, rent::DOUBLE < 0 AS a, rent::DOUBLE > 50000 AS b, TRY_CAST(s AS DOUBLE) < 0 AS c, TRY_CAST(s AS DOUBLE) > 20000 AS e, available_date LIKE '%/%' AS f,
  coalesce(unit_id, unit_number) IS NULL AS no_id, floor_plan_name IS NOT NULL AND bedrooms <> 'Studio' AS can FROM u)
SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN a THEN 'INVALID_RENT_NEGATIVE' WHEN b THEN 'INVALID_RENT_ABSURD' END, CASE WHEN c THEN 'INVALID_SQFT_NEGATIVE' WHEN e THEN 'INVALID_SQFT_ABSURD' END,
  CASE WHEN f THEN 'INVALID_DATE_FORMAT' END, CASE WHEN no_id AND NOT coalesce(can, false) THEN 'IDENTITY_FALLBACK_INSUFFICIENT' END) AS reasons, no_id AND coalesce(can, false) AS inferred_id FROM g"""


@query("q_v04_gate", _GATED)
def gate(spark, d):
    u = raw_units(spark, d).drop("market_rent_low", "asking_rent")
    q = F.col("l_quantity")
    u = u.withColumns({"rent": F.concat(F.when(F.col("l_tax") == 0.02, "-").otherwise(""), F.col("l_extendedprice").cast("decimal(12,2)")), "sqft": F.when(q == 7, "n/a").when(q == 8, "-5").when(q == 9, "20001").otherwise(F.col("sqft"))})
    return r.schema_gate(u).select("l_orderkey", "l_linenumber", F.array_join("reasons", ",").alias("reasons"), "inferred_id")


@query("q_v01_unit_issues", f"""WITH {RAW_UNITS}, u AS (SELECT *, (l_extendedprice::DECIMAL(12, 2)) AS lo, CASE WHEN l_tax < 0.05 THEN l_extendedprice::DECIMAL(12, 2) - 1 END AS hi, l_returnflag = 'R' AS less FROM raw)
SELECT l_orderkey, l_linenumber, severity, code, field FROM (
SELECT *, 'ERROR' AS severity, 'UNIT_INVALID_SCHEMA' AS code, '' AS field FROM u WHERE less UNION ALL SELECT *, 'ERROR', 'UNIT_MISSING_ID', 'unit_id' FROM u WHERE unit_id IS NULL
UNION ALL SELECT *, 'WARNING', 'UNIT_INVALID_RENT', 'market_rent_low' FROM u WHERE lo NOT BETWEEN 200 AND 50000 UNION ALL SELECT *, 'WARNING', 'UNIT_INVALID_RENT', 'market_rent_high' FROM u WHERE hi NOT BETWEEN 200 AND 50000
UNION ALL SELECT *, 'WARNING', 'UNIT_INVALID_RENT', 'market_rent_low > market_rent_high' FROM u WHERE lo > hi UNION ALL SELECT *, 'WARNING', 'UNIT_INVALID_DATE', 'available_date' FROM u WHERE available_date LIKE '%/%')""")
def unit_issues(spark, d):
    """Units as maps of texts, as loose records come; a returned item lacks two keys."""
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    pairs = {"unit_id": F.col("unit_id"), "market_rent_low": price, "market_rent_high": F.when(F.col("l_tax") < 0.05, price - 1), "available_date": F.col("available_date"), "lease_link": F.lit(None), "concessions": F.lit(None), "amenities": F.lit(None)}
    full = F.create_map(*[x for k, c in pairs.items() for x in (F.lit(k), c.cast("string"))])
    unit = F.when(F.col("l_returnflag") == "R", F.map_filter(full, lambda k, _: ~k.isin("concessions", "amenities"))).otherwise(full)
    u = raw_units(spark, d).select("l_orderkey", "l_linenumber", unit.alias("unit"))
    return u.select("l_orderkey", "l_linenumber", F.explode(r.unit_issues(F.col("unit"), F.map_keys("unit"))).alias("i")).select("l_orderkey", "l_linenumber", "i.*")


@query("q_v05_flags", """WITH o AS (SELECT o_custkey AS id, o_orderkey, floor(o_totalprice) AS rent, o_orderkey % 40 AS area, o_orderpriority AS plan FROM orders),
p AS (SELECT *, lag(rent) OVER w AS r0, lag(area) OVER w AS a0, lag(plan) OVER w AS p0 FROM o WINDOW w AS (PARTITION BY id ORDER BY o_orderkey))
SELECT id, o_orderkey, concat_ws(',', CASE WHEN r0 > 0 AND abs(rent - r0) / r0 * 100 > 50 THEN 'rent_swing_>50pct' WHEN r0 > 0 AND abs(rent - r0) / r0 * 100 > 20 THEN 'rent_swing_>20pct' END,
  CASE WHEN a0 > 0 AND abs(area - a0) / a0 * 100 > 5 THEN 'sqft_changed' END, CASE WHEN lower(plan) <> lower(p0) THEN 'floor_plan_renamed' END) AS flags FROM p""")
def flags(spark, d):
    """Every order against its customer's order before."""
    w = Window.partitionBy("id").orderBy("o_orderkey")
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("id"), "o_orderkey", F.floor("o_totalprice").alias("rent"), (F.col("o_orderkey") % 40).alias("area"), F.col("o_orderpriority").alias("plan"))
    before = lambda c: F.lag(c).over(w)
    return o.select("id", "o_orderkey", F.array_join(r.sanity_flags(F.col("rent"), before("rent"), F.col("area"), before("area"), F.col("plan"), before("plan")), ",").alias("flags"))


@query("q_f39_unreachable", "SELECT event_id, event_id % 7 IN (1, 2, 5) AS unreachable FROM events")
def unreachable(spark, d):
    errors = {1: "net::ERR_FAILED at x", 2: "Page: NS_ERROR_UNKNOWN_HOST", 3: "err_connection_refused", 4: "", 5: "ERR_CERT_DATE_INVALID"}
    text = F.lit(None).cast("string")
    for k, t in errors.items():
        text = F.when(F.col("event_id") % 7 == k, t).otherwise(text)
    return table(spark, d, "events").select("event_id", r.is_unreachable(text).alias("unreachable"))


@query("q_o09_cta", "SELECT page_id, (SELECT coalesce(max(w), 0) FROM (VALUES ('availab', 100), ('floor', 80), ('pricing', 70), ('apply', 50), ('lease', 40), ('unit', 60), ('apartment', 55), ('resident', 30)) k(word, w) WHERE contains(lower(html), word))::INT AS priority FROM pages")
def cta(spark, d):
    return table(spark, d, "pages").select("page_id", r.cta_priority(F.col("html")).alias("priority"))


@query("q_o10_by_count", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS cost, row_number() OVER (ORDER BY count(*) DESC, event_type) AS place FROM events GROUP BY 1")
def by_count(spark, d):
    """One row a type, sorted by count."""
    e = table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("cost"))
    return e.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "event_type"))).orderBy("place")


@query("q_p25_signals", "SELECT event_id, event_id % 3 = 0 AS signals FROM events")
def signals(spark, d):
    k = F.col("event_id") % 3
    body = F.when(k == 0, F.to_json(F.struct(F.col("value").alias("minRent"), F.col("user_id").alias("unit_id")), {"ignoreNullFields": "false"})).when(k == 1, F.to_json(F.struct(F.col("value").alias("rent"), F.lit(1).alias("other")), {"ignoreNullFields": "false"})).otherwise(F.lit("[1]"))
    return table(spark, d, "events").select("event_id", r.has_unit_signals(body).alias("signals"))


@query("q_p06_public", "SELECT c_custkey AS id, c_name AS name FROM customer")
def public(spark, d):
    return r.public_columns(table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("_balance"), F.lit(1).alias("_x.y")))


@query("q_k15_costs", """SELECT event_id, user_id, CASE event_type WHEN 'view' THEN 'proxy_mb' WHEN 'click' THEN 'vision' ELSE 'llm' END AS category, CASE event_type WHEN 'view' THEN value * 65536 / 1048576 * 0.5 ELSE value END AS cost_usd FROM events WHERE value IS NOT NULL""")
def costs(spark, d):
    """Entries of the cost ledger, not rounded; traffic is priced by the megabyte."""
    kind = F.when(F.col("event_type") == "view", "proxy_mb").when(F.col("event_type") == "click", "vision").otherwise("llm")
    e = table(spark, d, "events").where("value is not null").withColumn("category", kind)
    return e.select("event_id", "user_id", "category", F.when(F.col("category") == "proxy_mb", F.col("value") * 65536 / 1048576 * 0.5).otherwise(F.col("value")).alias("cost_usd"))


@query("q_k14_versions", "SELECT user_id, max(event_id) AS event_id, count(*) AS version FROM events GROUP BY 1")
def versions(spark, d):
    """Current version of a document that is written anew by each event; older versions stay as the audit copy."""
    w = Window.partitionBy("user_id").orderBy("event_id")
    log = table(spark, d, "events").select("user_id", "event_id", F.row_number().over(w).cast("long").alias("version"))
    return frames.latest_by_struct(log, ["user_id"], ["version"]).select("user_id", "event_id", "version")


@query("q_k08_flags", f"WITH {PROPERTIES}, e AS (SELECT user_id AS id, max_by(event_type, event_id) AS last FROM events WHERE event_type IN ('error', 'purchase') GROUP BY 1) SELECT id, coalesce(last = 'error', status = 'BUILDING') AS parked FROM props LEFT JOIN e USING (id)")
def parked(spark, d):
    """The last order to park (error) or unpark (purchase) a property holds; others keep their flag."""
    e = table(spark, d, "events").where(F.col("event_type").isin("error", "purchase")).groupBy(F.col("user_id").alias("id")).agg(F.max_by("event_type", "event_id").alias("last"))
    return properties(spark, d).join(e, "id", "left").select("id", F.coalesce(F.col("last") == "error", F.col("status") == "BUILDING").alias("parked"))


_E = "e AS (SELECT user_id AS id, count(*) FILTER (event_type = 'error') AS bad, max(ts) AS last, min(ts) FILTER (event_type = 'error') + INTERVAL 1 DAY AS due, count(*) AS n FROM events GROUP BY 1), m AS (SELECT max(ts) AS now FROM events)"


@query("q_t13_tasks", f"""WITH {PROPERTIES}, {_E}, t AS (
  SELECT id, city AS host, 0 AS priority, 'DLQ_REVIVE' AS reason, 'RENDER' AS mode FROM props JOIN e USING (id), m WHERE bad >= 3 AND due <= now
  UNION ALL SELECT id, city, CASE WHEN n IS NULL OR now - last > INTERVAL 7 DAY THEN 1 ELSE 2 END, 'SCHEDULED', CASE WHEN n IS NULL OR now - last > INTERVAL 7 DAY THEN 'RENDER' ELSE 'GET' END FROM props LEFT JOIN e USING (id), m WHERE coalesce(bad, 0) < 3)
SELECT *, row_number() OVER (PARTITION BY priority, host ORDER BY id) AS turn FROM t""")
def tasks(spark, d):
    """Parked properties whose time has come, then pages to render, then light ones; hosts take turns within each."""
    e = table(spark, d, "events")
    bad = F.col("event_type") == "error"
    own = e.groupBy(F.col("user_id").alias("id")).agg(F.count_if(bad).alias("bad"), F.max("ts").alias("last"), (F.min(F.when(bad, F.col("ts"))) + F.expr("INTERVAL 1 DAY")).alias("due"), F.count(F.lit(1)).alias("n"))
    p = properties(spark, d).join(own, "id", "left").crossJoin(F.broadcast(e.agg(F.max("ts").alias("now"))))
    many = F.coalesce("bad", F.lit(0)) >= 3
    render = F.col("n").isNull() | (F.col("last") < F.col("now") - F.expr("INTERVAL 7 DAYS"))
    p = p.where(~many | (F.col("due") <= F.col("now")))
    t = p.select("id", F.col("city").alias("host"), F.when(many, 0).when(render, 1).otherwise(2).alias("priority"), F.when(many, "DLQ_REVIVE").otherwise("SCHEDULED").alias("reason"), F.when(many | render, "RENDER").otherwise("GET").alias("mode"))
    return t.withColumn("turn", F.row_number().over(Window.partitionBy("priority", "host").orderBy("id")))


_RANK = "row_number() OVER (PARTITION BY event_type ORDER BY value) AS rn, count(*) OVER (PARTITION BY event_type) AS n"


@query("q_a22_percentile", f"WITH r AS (SELECT event_type, value, {_RANK} FROM events WHERE value IS NOT NULL) SELECT event_type, max(value) FILTER (rn = floor(n * 0.5) + 1) AS p50, max(value) FILTER (rn = floor(n * 0.95) + 1) AS p95 FROM r GROUP BY 1")
def percentile_index(spark, d):
    return r.exact_ranks(table(spark, d, "events"), "event_type", "value", {"p50": F.floor(F.col("n") * 0.5) + 1, "p95": F.floor(F.col("n") * 0.95) + 1})


@query("q_a23_percentile", f"WITH r AS (SELECT event_type, value, {_RANK} FROM events WHERE value IS NOT NULL) SELECT event_type, max(value) FILTER (rn = round_even(0.95 * (n - 1), 0) + 1) AS p95 FROM r GROUP BY 1")
def percentile_nearest(spark, d):
    return r.exact_ranks(table(spark, d, "events"), "event_type", "value", {"p95": F.bround(F.lit(0.95) * (F.col("n") - 1)) + 1})


@query("q_t11_proxy_health", """WITH RECURSIVE e AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n, CASE WHEN event_type = 'error' THEN -25 ELSE 5 END AS a FROM events),
h(user_id, n, x) AS (SELECT DISTINCT user_id, 0::BIGINT, 100 FROM events UNION ALL SELECT h.user_id, e.n, greatest(10, least(100, h.x + e.a)) FROM h JOIN e ON e.user_id = h.user_id AND e.n = h.n + 1)
SELECT user_id, round(max_by(x, n) / 100, 6) AS health, max_by(x, n) >= 25 AS usable FROM h GROUP BY 1""")
def proxy_health(spark, d):
    """Health of each user's proxy in hundredths: +5 a success, -25 a failure, kept in 10..100, in order of time."""
    e = table(spark, d, "events")
    step = F.when(F.col("event_type") == "error", -25).otherwise(5)
    out = r.clamped_walk(e, "user_id", ["ts", "event_id"], step, 10, 100, 100, F.date_trunc("hour", "ts"))
    return out.select("user_id", F.round(F.col("last") / 100, 6).alias("health"), (F.col("last") >= 25).alias("usable"))
