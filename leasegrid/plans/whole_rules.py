"""Rules in their full form over the given tables, beside the shorter forms of other modules."""

from __future__ import annotations

from pyspark.sql import functions as F

from leasegrid.functions import decisions as rules
from leasegrid.operators import frames, rolling
from leasegrid.plans.rules import HREFS, links
from leasegrid.plans.tables import PROPERTIES, properties, table

ALL: dict = {}


def query(name: str, sql: str | None = None):
    return lambda f: ALL.setdefault(name, (f, sql)) and f


# V03: a property's own fields; its units' are q_v03_issues and the rents below.
_PROPS = """p AS (SELECT id, CASE WHEN id % 7 = 0 THEN NULL WHEN id % 7 = 1 THEN 0 ELSE id END AS apartment_id, CASE WHEN id % 5 = 0 THEN '  ' ELSE name END AS proj_name, city, CASE WHEN id % 6 > 0 THEN state END AS state,
  CASE id % 4 WHEN 0 THEN lpad(id::VARCHAR, 5, '0') WHEN 1 THEN id || '-1' WHEN 2 THEN '' END AS zip_code, CASE WHEN balance > 0 THEN 'https://p' || id END AS website FROM props)"""
_REQUIRED = " UNION ALL ".join(f"SELECT id, 'ERROR' AS severity, 'V2_MISSING_REQUIRED' AS code, '{c}' AS field FROM p WHERE {c} IS NULL OR trim({c}::VARCHAR) = ''" for c in ("apartment_id", "proj_name", "city", "state", "zip_code", "website"))


@query("q_v03_property_issues", f"WITH {PROPERTIES}, {_PROPS} {_REQUIRED} UNION ALL SELECT id, 'ERROR', 'V2_INVALID_APARTMENT_ID', 'apartment_id' FROM p WHERE apartment_id < 1 UNION ALL SELECT id, 'WARNING', 'V2_INVALID_ZIP', 'zip_code' FROM p WHERE NOT regexp_full_match(zip_code, '[0-9]{{5}}')")
def property_issues(spark, d):
    """Required fields, ids under 1 and ZIP codes that aren't five digits; an empty ZIP counts as both missing and wrong."""
    k = F.col("id")
    p = properties(spark, d).select(
        "id", F.when(k % 7 == 0, None).when(k % 7 == 1, 0).otherwise(k).alias("apartment_id"), F.when(k % 5 == 0, "  ").otherwise(F.col("name")).alias("proj_name"), "city", F.when(k % 6 > 0, F.col("state")).alias("state"),
        F.when(k % 4 == 0, F.lpad(k.cast("string"), 5, "0")).when(k % 4 == 1, F.concat(k, F.lit("-1"))).when(k % 4 == 2, "").alias("zip_code"), F.when(F.col("balance") > 0, F.concat(F.lit("https://p"), k)).alias("website"),
    )
    return frames.property_issues_v2(p, "id", ("apartment_id", "proj_name", "city", "state", "zip_code", "website"))


@query("q_v03_rents", """WITH u AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_tax > 0.02 THEN l_extendedprice * l_discount / 100 END AS lo, CASE WHEN l_returnflag <> 'R' THEN l_extendedprice * l_tax / 100 END AS hi FROM lineitem)
SELECT l_orderkey, l_linenumber, 'rent_low' AS field, 'WARNING' AS severity, 'V2_INVALID_RENT' AS code FROM u WHERE lo <= 1 UNION ALL SELECT l_orderkey, l_linenumber, 'rent_high', 'WARNING', 'V2_INVALID_RENT' FROM u WHERE hi <= 1
UNION ALL SELECT l_orderkey, l_linenumber, 'rent_low > rent_high', 'WARNING', 'V2_INVALID_RENT' FROM u WHERE lo > hi""")
def rents(spark, d):
    """Rents of 1 or less, one row for each field, and low rents above the high one."""
    price = F.col("l_extendedprice")
    u = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_tax") > 0.02, price * F.col("l_discount") / 100).alias("lo"), F.when(F.col("l_returnflag") != "R", price * F.col("l_tax") / 100).alias("hi"))
    lo, hi = F.col("lo"), F.col("hi")
    bad = F.array_compact(F.array(F.when(lo <= 1, F.lit("rent_low")), F.when(hi <= 1, F.lit("rent_high")), F.when(lo > hi, F.lit("rent_low > rent_high"))))
    return u.select("l_orderkey", "l_linenumber", F.explode(bad).alias("field"), F.lit("WARNING").alias("severity"), F.lit("V2_INVALID_RENT").alias("code"))


_PATH = "lower(regexp_extract(absolute, '^[a-z]+://[^/?#]*([^?#]*)', 1))"
_WORDS = " OR ".join(f"contains({_PATH}, '{w}')" for w in rules.PROPERTY_WORDS)


@query("q_p26_exploratory", rf"""WITH {HREFS}, a AS (SELECT page_id, url, CASE page_id % 4 WHEN 0 THEN origin || '/' || replace(href, '/', '') || '/page' WHEN 1 THEN origin || '/Contact/' || replace(href, '/', '') WHEN 2 THEN 'https://elsewhere.example/' || page_id ELSE origin || '/Floorplans/' || page_id END AS absolute FROM links)
SELECT page_id, absolute, page_id % 4 <> 2 AND {_PATH} NOT IN ('', '/', lower(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1))) AND NOT ({_WORDS}) AND NOT regexp_matches({_PATH}, '{rules.NON_PROPERTY}') AS exploratory FROM a""")
def exploratory(spark, d):
    """Links of the same host that neither look like units nor lead to a page that never has any."""
    k, bare = F.col("page_id"), F.translate("href", "/", "")
    origin = F.regexp_extract("url", r"^([^:]+://[^/?#]*)", 1)
    made = F.when(k % 4 == 0, F.concat(origin, F.lit("/"), bare, F.lit("/page"))).when(k % 4 == 1, F.concat(origin, F.lit("/Contact/"), bare)).when(k % 4 == 2, F.concat(F.lit("https://elsewhere.example/"), k)).otherwise(F.concat(origin, F.lit("/Floorplans/"), k))
    a = links(spark, d).select("page_id", "url", made.alias("absolute"))
    return a.select("page_id", "absolute", rules.exploratory_link(F.col("absolute"), F.col("url")).alias("exploratory"))


@query("q_w07_sticky", """WITH e AS (SELECT event_id, 'h' || user_id AS domain, floor(epoch(ts))::BIGINT AS s, event_type = 'error' AS bad FROM events), r AS (SELECT *, count(*) OVER w AS n, count(*) FILTER (bad) OVER w AS errors FROM e WINDOW w AS (PARTITION BY domain ORDER BY s RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW))
SELECT event_id, domain, n, errors, max((errors > 0.02 * n)::INT) OVER (PARTITION BY domain ORDER BY s RANGE UNBOUNDED PRECEDING) = 1 AS forced FROM r""")
def sticky(spark, d):
    """Failures of a domain's last seven days; over 2 % once, a domain stays forced."""
    e = table(spark, d, "events").select("event_id", F.concat(F.lit("h"), F.col("user_id")).alias("domain"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("s"), (F.col("event_type") == "error").alias("bad"))
    found = rolling.rolling_failures(e, "domain", "s", "bad", span=604_800, threshold=0.02)
    return found.select("event_id", "domain", "n", "errors", "forced")


@query("q_t07_maturity_steps", """WITH e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k, event_type <> 'error' AS ok, event_type, value FROM events),
b AS (SELECT *, sum((NOT ok)::INT) OVER w AS bads, sum(ok::INT) OVER w AS goods FROM e WINDOW w AS (PARTITION BY user_id ORDER BY k)), s AS (SELECT *, CASE WHEN ok THEN row_number() OVER (PARTITION BY user_id, ok, bads ORDER BY k) ELSE 0 END AS good, CASE WHEN NOT ok THEN row_number() OVER (PARTITION BY user_id, ok, goods ORDER BY k) ELSE 0 END AS bad FROM b),
m AS (SELECT *, CASE WHEN good >= 3 THEN 'HOT' WHEN good >= 1 THEN 'WARM' WHEN bad >= 3 THEN 'COLD' END AS set FROM s)
SELECT user_id, event_id, good::BIGINT AS successes, bad::BIGINT AS failures, coalesce(last_value(set IGNORE NULLS) OVER w, 'COLD') AS maturity, min(CASE WHEN ok THEN CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 3 ELSE 4 END END) OVER w AS preferred_tier FROM m WINDOW w AS (PARTITION BY user_id ORDER BY k)""")
def maturity_steps(spark, d):
    """A profile after each of its scrapes: streaks, the maturity they set (a broken streak keeps it), and the lowest tier that worked."""
    e = table(spark, d, "events").withColumn("ok", F.col("event_type") != "error").withColumn("tier", F.when(F.col("event_type") == "view", 1).when(F.col("event_type") == "click", 3).otherwise(4))
    found = rolling.maturity_steps(e, "user_id", ["ts", "event_id"], F.col("ok"), F.col("tier"))
    return found.select("user_id", "event_id", "successes", "failures", "maturity", "preferred_tier")


@query("q_p17_needs_retry", """WITH r AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'tier_4_fail' ELSE 'TIER_1_API' END AS tier, CASE WHEN o_orderstatus = 'P' THEN 'Failed' END AS verdict, CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE 3 END AS units, CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END AS errors FROM orders)
SELECT o_orderkey, contains(upper(tier), 'FAIL') OR coalesce(contains(upper(verdict), 'FAIL'), false) OR units = 0 AS resume, contains(upper(tier), 'FAIL') OR coalesce(contains(upper(verdict), 'FAIL'), false) OR units = 0 OR errors > 0 AS retry FROM r""")
def retry(spark, d):
    """Records to scrape again: failed tier or verdict, no units or, unless a run is only resumed, any error."""
    k = F.col("o_orderkey")
    r = table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", "tier_4_fail").otherwise("TIER_1_API").alias("tier"), F.when(F.col("o_orderstatus") == "P", "Failed").alias("verdict"),
        F.when(k % 9 == 0, F.array().cast("array<int>")).otherwise(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("units"), F.when(k % 4 == 0, F.array(F.lit("timeout"))).alias("errors"),
    )
    needed = lambda errors: rules.needs_retry(F.col("tier"), F.col("verdict"), F.col("units"), errors)
    return r.select("o_orderkey", needed(F.array().cast("array<string>")).alias("resume"), needed(F.col("errors")).alias("retry"))


@query("q_v09_smoke", """WITH e AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'SUCCESS' WHEN 'click' THEN 'SKIPPED' WHEN 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS outcome, event_id % 5 > 0 AS found, event_id % 3 AS units, event_id % 7 AS tier, event_id % 2 = 0 AS banner, CASE WHEN event_id % 11 > 0 THEN value / 50 END AS confidence FROM events)
SELECT event_id, problem FROM (SELECT event_id, unnest([CASE WHEN outcome NOT IN ('SUCCESS', 'SKIPPED') THEN 'outcome' END, CASE WHEN NOT found THEN 'missing output' END, CASE WHEN found AND outcome = 'SUCCESS' AND units = 0 THEN 'no units' END,
  CASE WHEN found AND outcome = 'SUCCESS' AND tier NOT BETWEEN 1 AND 5 THEN 'tier' END, CASE WHEN found AND outcome = 'SUCCESS' AND NOT banner THEN 'banner' END, CASE WHEN found AND outcome = 'SUCCESS' AND (confidence IS NULL OR confidence NOT BETWEEN 0 AND 1) THEN 'confidence' END]) AS problem FROM e) WHERE problem IS NOT NULL""")
def smoke(spark, d):
    """What is wrong with each event of a run and the output beside it."""
    k, kind = F.col("event_id"), F.col("event_type")
    e = table(spark, d, "events").select("event_id", F.when(kind == "click", "SKIPPED").when(kind == "error", "FAILED").otherwise("SUCCESS").alias("outcome"), (k % 5 > 0).alias("found"), (k % 3).alias("units"), (k % 7).alias("tier"), (k % 2 == 0).alias("banner"), F.when(k % 11 > 0, F.col("value") / 50).alias("confidence"))
    return e.select("event_id", F.explode(rules.smoke_problems(*[F.col(c) for c in ("outcome", "found", "units", "tier", "banner", "confidence")])).alias("problem"))
