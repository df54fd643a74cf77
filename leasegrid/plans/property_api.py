"""The read API over properties and units: summaries, filter, search, sort, page, top-k, detail, market metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leasegrid.functions import values as v
from leasegrid.operators import frames
from leasegrid.plans.tables import PROPERTIES, UNITS, properties, table, units

ALL: dict = {}
RENT = "asking > 0"


def query(name: str, sql: str | None = None):
    return lambda f: ALL.setdefault(name, (f, sql)) and f


def summaries(spark, d) -> DataFrame:
    """One row a property: units, available, avg and upper-median rent, availability, tier."""
    stats = units(spark, d).groupBy("id").agg(
        F.count(F.lit(1)).alias("n_units"),
        F.count_if("available").alias("n_available"),
        v.half_up(F.avg(F.when(F.expr(RENT), F.col("asking")))).alias("avg_rent"),
        v.upper_median(F.when(F.expr(RENT), F.col("asking"))).alias("median_rent"),
    )
    rows = properties(spark, d).join(stats, "id", "left")
    tier = F.when(F.coalesce("n_units", F.lit(0)) == 0, "FAILED").when(F.coalesce("avg_rent", F.lit(0)) == 0, "TIER_3_DOM").otherwise("TIER_1_API")
    return rows.select("id", "name", "city", "state", "status", F.coalesce("n_units", F.lit(0)).alias("n_units"), F.coalesce("n_available", F.lit(0)).alias("n_available"), F.coalesce("avg_rent", F.lit(0.0)).alias("avg_rent"), F.coalesce("median_rent", F.lit(0.0)).alias("median_rent"), tier.alias("tier"), F.when(F.coalesce("n_units", F.lit(0)) > 0, F.round(F.col("n_available") / F.col("n_units"), 6)).otherwise(0.0).alias("availability"))


SUMMARY = f"""{PROPERTIES}, {UNITS},
ranked AS (SELECT id, asking, row_number() OVER (PARTITION BY id ORDER BY asking) AS rn, count(*) OVER (PARTITION BY id) AS n FROM units WHERE {RENT}),
stats AS (SELECT id, count(*) AS n_units, count(*) FILTER (available) AS n_available, floor(avg(asking) FILTER ({RENT}) + 0.5) AS avg_rent FROM units GROUP BY id),
med AS (SELECT id, asking AS median_rent FROM ranked WHERE rn = n // 2 + 1),
summary AS (SELECT p.id, name, city, state, status, coalesce(n_units, 0) AS n_units, coalesce(n_available, 0) AS n_available, coalesce(avg_rent, 0.0) AS avg_rent,
  coalesce(median_rent, 0.0) AS median_rent, CASE WHEN coalesce(n_units, 0) = 0 THEN 'FAILED' WHEN coalesce(avg_rent, 0) = 0 THEN 'TIER_3_DOM' ELSE 'TIER_1_API' END AS tier,
  CASE WHEN n_units > 0 THEN round(n_available / n_units, 6) ELSE 0.0 END AS availability
  FROM props p LEFT JOIN stats USING (id) LEFT JOIN med USING (id))"""


@query("q_p07_summary", f"WITH {SUMMARY} SELECT * FROM summary")
def summary(spark, d):
    return summaries(spark, d)


@query("q_p13_filter", f"WITH {SUMMARY} SELECT * FROM summary WHERE contains(lower(name), '1') AND status IN ('BUILDING', 'MACHINERY') AND avg_rent BETWEEN 100000 AND 300000")
def filtered(spark, d):
    return frames.property_filter(summaries(spark, d), search="1", statuses=("BUILDING", "MACHINERY"), least_rent=100_000, most_rent=300_000, search_in=("name",))


@query("q_p14_search", f"WITH {PROPERTIES} SELECT id, name, city FROM props WHERE contains(lower(name), 'er#00000001') OR contains(lower(city), '7') ORDER BY id LIMIT 20")
def search(spark, d):
    return frames.property_filter(properties(spark, d), search="7", search_in=("city",)).unionByName(frames.property_filter(properties(spark, d), search="er#00000001", search_in=("name",))).distinct().orderBy("id").limit(20).select("id", "name", "city")


@query("q_p16_lookup", f"WITH {PROPERTIES} SELECT * FROM props WHERE id = 42")
def lookup(spark, d):
    return properties(spark, d).where("id = 42")


@query("q_o01_sort_nulls_last", f"WITH {PROPERTIES} SELECT id, CASE WHEN id % 3 > 0 THEN balance END AS balance, row_number() OVER (ORDER BY CASE WHEN id % 3 > 0 THEN balance END DESC NULLS LAST, id) AS place FROM props")
def sorted_(spark, d):
    """Every row with its place: places are counted in parts of the sorted table, so no task holds it whole."""
    rows = properties(spark, d).select("id", F.when(F.col("id") % 3 > 0, F.col("balance")).alias("balance"))
    return frames.placed(rows, "place", F.col("balance").desc_nulls_last(), F.col("id").asc())


@query("q_o01_sort_all", f"WITH {PROPERTIES} SELECT id, CASE WHEN id % 3 > 0 THEN balance END AS balance FROM props ORDER BY balance DESC NULLS LAST, id")
def sorted_all(spark, d):
    """The whole sort; q_o01_sort_nulls_last has the places too."""
    return frames.sort_nulls_last(properties(spark, d).select("id", F.when(F.col("id") % 3 > 0, F.col("balance")).alias("balance")), "balance", True, "id")


@query("q_o02_page", f"WITH {SUMMARY} SELECT * FROM summary ORDER BY avg_rent DESC NULLS LAST, id LIMIT 25 OFFSET 50")
def paged(spark, d):
    return frames.page(summaries(spark, d), "avg_rent", True, "id", number=3, size=25)


@query("q_o02_total", f"WITH {PROPERTIES} SELECT count(*) AS total, ceil(count(*) / 25)::BIGINT AS pages FROM props")
def total(spark, d):
    return properties(spark, d).agg(F.count(F.lit(1)).alias("total"), F.ceil(F.count(F.lit(1)) / 25).alias("pages"))


@query("q_o03_topk", f"WITH {SUMMARY} SELECT id, name, median_rent FROM summary ORDER BY median_rent DESC, id LIMIT 10")
def ranked(spark, d):
    return frames.top_k(summaries(spark, d), "median_rent", 10, "id").select("id", "name", "median_rent")


@query("q_a04_upper_median", f"WITH {SUMMARY} SELECT id, median_rent FROM summary")
def medians(spark, d):
    return summaries(spark, d).select("id", "median_rent")


@query("q_a05_availability", "SELECT l_partkey AS id, count(*) AS n, round(count(*) FILTER (l_linestatus = 'O') / count(*), 6) AS availability FROM lineitem GROUP BY 1")
def availability(spark, d):
    li = table(spark, d, "lineitem")
    return li.groupBy(F.col("l_partkey").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.round(F.count_if(F.col("l_linestatus") == "O") / F.count(F.lit(1)), 6).alias("availability"))


@query("q_a06_floor_plans", f"WITH {UNITS} SELECT coalesce(plan, 'Unknown') AS plan, count(*) AS n, count(*) FILTER (available) AS n_available, round(avg(asking) FILTER ({RENT}), 2) AS avg_rent, min(asking) FILTER ({RENT}) AS min_rent, max(asking) FILTER ({RENT}) AS max_rent FROM units GROUP BY 1")
def floor_plans(spark, d):
    rent = F.when(F.expr(RENT), F.col("asking"))
    return units(spark, d).groupBy(F.coalesce("plan", F.lit("Unknown")).alias("plan")).agg(F.count(F.lit(1)).alias("n"), F.count_if("available").alias("n_available"), F.round(F.avg(rent), 2).alias("avg_rent"), F.min(rent).alias("min_rent"), F.max(rent).alias("max_rent"))


@query("q_a07_metrics", f"WITH {UNITS} SELECT id, min(asking) AS lo, max(asking) AS hi, round(avg(asking), 6) AS mean, round(1 - count(*) FILTER (available) / count(*), 6) AS occupancy FROM units GROUP BY id")
def metrics(spark, d):
    return units(spark, d).groupBy("id").agg(F.min("asking").alias("lo"), F.max("asking").alias("hi"), F.round(F.avg("asking"), 6).alias("mean"), F.round(1 - F.count_if("available") / F.count(F.lit(1)), 6).alias("occupancy"))


@query("q_a08_stats", f"WITH {SUMMARY} SELECT state, count(*) AS n_properties, sum(n_units)::BIGINT AS n_units, sum(n_available)::BIGINT AS n_available, round(avg(avg_rent) FILTER (avg_rent > 0), 2) AS avg_rent, round(count(*) FILTER (tier <> 'FAILED') / count(*), 6) AS success_rate FROM summary GROUP BY state")
def stats(spark, d):
    s = summaries(spark, d)
    return s.groupBy("state").agg(F.count(F.lit(1)).alias("n_properties"), F.sum("n_units").alias("n_units"), F.sum("n_available").alias("n_available"), F.round(F.avg(F.when(F.col("avg_rent") > 0, F.col("avg_rent"))), 2).alias("avg_rent"), F.round(F.count_if(F.col("tier") != "FAILED") / F.count(F.lit(1)), 6).alias("success_rate"))


@query("q_a08_histograms", f"WITH {SUMMARY} SELECT 'tier' AS what, tier AS value, count(*) AS n FROM summary GROUP BY 2 UNION ALL SELECT 'city', city, count(*) FROM summary GROUP BY 2")
def histograms(spark, d):
    s = summaries(spark, d)
    one = lambda c: s.groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(c).alias("what"), "value", "n")
    return one("tier").union(one("city"))


@query("q_a01_mix", f"WITH {UNITS}, n AS (SELECT id, left(plan, 1) || 'BR' AS label, count(*) AS n FROM units GROUP BY 1, 2) SELECT id, string_agg(label || ' x' || n, ', ' ORDER BY label) AS mix, sum(n)::BIGINT AS n_units FROM n GROUP BY id")
def mix(spark, d):
    n = units(spark, d).groupBy("id", F.concat(F.substring("plan", 1, 1), F.lit("BR")).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    parts = F.sort_array(F.collect_list(F.struct("label", "n")))
    return n.groupBy("id").agg(F.array_join(F.transform(parts, lambda p: F.concat(p["label"], F.lit(" x"), p["n"].cast("string"))), ", ").alias("mix"), F.sum("n").alias("n_units"))


@query("q_p09_unit_dto", "SELECT l_orderkey, l_linenumber, round((l_extendedprice * (1 - l_discount) + l_extendedprice) / 2, 6) AS asking, CASE WHEN l_quantity > 0 THEN floor((l_extendedprice * (1 - l_discount) + l_extendedprice) / 2 / l_quantity * 100 + 0.5) / 100 END AS rent_per_sqft FROM lineitem")
def unit_dto(spark, d):
    asking = (F.col("l_extendedprice") * (1 - F.col("l_discount")) + F.col("l_extendedprice")) / 2
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(asking, 6).alias("asking"), F.when(F.col("l_quantity") > 0, v.half_up(asking / F.col("l_quantity"), 2)).alias("rent_per_sqft"))


@query("q_p10_tier", f"WITH {SUMMARY} SELECT tier, count(*) AS n FROM summary GROUP BY tier")
def tiers(spark, d):
    return summaries(spark, d).groupBy("tier").agg(F.count(F.lit(1)).alias("n"))


@query("q_p11_status", f"WITH {PROPERTIES} SELECT id, CASE WHEN contains(upper(status), 'LEASE') THEN 'LEASE_UP' WHEN contains(upper(status), 'STAB') THEN 'STABILISED' WHEN contains(upper(status), 'OFFLINE') OR contains(upper(status), 'CLOSED') THEN 'OFFLINE' ELSE 'ACTIVE' END AS property_status FROM props")
def statuses(spark, d):
    return properties(spark, d).select("id", v.property_status(F.col("status")).alias("property_status"))


@query("q_j01_left_lookup", f"WITH {PROPERTIES}, {UNITS}, x AS (SELECT id, max(day) AS last_day FROM units GROUP BY id) SELECT p.id, p.name, x.last_day, x.id IS NOT NULL AS indexed FROM props p LEFT JOIN x ON p.id = x.id")
def left_lookup(spark, d):
    last = units(spark, d).groupBy("id").agg(F.max("day").alias("last_day"))
    return properties(spark, d).join(last, "id", "left").select("id", "name", "last_day", F.col("last_day").isNotNull().alias("indexed"))


@query("q_j03_cost", f"WITH {PROPERTIES}, c AS (SELECT user_id AS id, round(sum(value), 4) AS cost FROM events GROUP BY 1) SELECT p.id, coalesce(c.cost, 0.0) AS cost FROM props p LEFT JOIN c USING (id)")
def with_cost(spark, d):
    cost = table(spark, d, "events").groupBy(F.col("user_id").alias("id")).agg(F.round(F.sum("value"), 4).alias("cost"))
    return properties(spark, d).join(cost, "id", "left").select("id", F.coalesce("cost", F.lit(0.0)).alias("cost"))


@query("q_u02_difference", f"WITH {PROPERTIES}, {UNITS} SELECT id FROM props EXCEPT SELECT id FROM units")
def difference(spark, d):
    return properties(spark, d).select("id").join(units(spark, d).select("id"), "id", "left_anti").distinct()


@query("q_u03_intersection", "SELECT DISTINCT o_custkey AS id FROM orders WHERE year(o_orderdate) = 1995 INTERSECT SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1996")
def intersection(spark, d):
    u = units(spark, d)
    return u.where(F.year("day") == 1995).select("id").intersect(u.where(F.year("day") == 1996).select("id"))
