"""Scalar rules bound to columns of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from leasegrid.functions import decisions
from leasegrid.functions import values as v
from leasegrid.plans.tables import properties, table

ALL: dict = {}


def query(name: str, sql: str | None = None):
    return lambda f: ALL.setdefault(name, (f, sql)) and f


_HOST = r"""regexp_replace(lower(regexp_extract(url, '^[^:]+://([^/?#]*)', 1)), '^www\.', '')"""


@query("q_f04_host", f"SELECT page_id, {_HOST} AS host FROM pages")
def host(spark, d):
    return table(spark, d, "pages").select("page_id", v.host(F.col("url")).alias("host"))


@query("q_f08_website_fp", f"SELECT page_id, 'web_' || left(sha1({_HOST}), 16) AS fp FROM pages")
def website(spark, d):
    return table(spark, d, "pages").select("page_id", v.website_fingerprint(F.col("url")).alias("fp"))


_STREET = """MAP {'street': 'st', 'avenue': 'ave', 'av': 'ave', 'boulevard': 'blvd', 'road': 'rd', 'drive': 'dr', 'lane': 'ln', 'court': 'ct', 'place': 'pl',
  'terrace': 'ter', 'parkway': 'pkwy', 'highway': 'hwy', 'circle': 'cir', 'square': 'sq', 'north': 'n', 'south': 's', 'east': 'e', 'west': 'w',
  'northeast': 'ne', 'northwest': 'nw', 'southeast': 'se', 'southwest': 'sw', 'apartment': 'apt', 'suite': 'ste', 'floor': 'fl'}"""


_WHOLE = rf"""SELECT doc_id, array_to_string(list_transform(list_filter(string_split(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}\p{{M}}_]+', ' ', 'g'), ' '), lambda w: w <> ''),
  lambda w: coalesce({_STREET}[w], w)), ' ') AS address FROM documents"""


@query("q_f01_address", _WHOLE)
@query("q_f01_address_whole", _WHOLE)
def address_whole(spark, d):
    """Every whole text, under either name."""
    return table(spark, d, "documents").select("doc_id", v.address(F.col("text")).alias("address"))


@query("q_f03_zip", r"SELECT l_orderkey, l_linenumber, lpad(regexp_replace((l_partkey * 7)::VARCHAR, '\D', '', 'g'), greatest(5, 0), '0')[1:5] AS zip FROM lineitem")
def zip_(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", v.zip_any((F.col("l_partkey") * 7).cast("string")).alias("zip"))


@query("q_f07_geo_fp", "SELECT c_custkey, CASE WHEN c_acctbal / 100 BETWEEN -90 AND 90 AND c_custkey / 10.0 BETWEEN -180 AND 180 THEN 'geo_' || printf('%.4f', c_acctbal / 100) || '_' || printf('%.4f', c_custkey / 10.0) ELSE '' END AS fp FROM customer")
def geo(spark, d):
    c = table(spark, d, "customer")
    ok = (F.col("c_acctbal") / 100).between(-90, 90)
    return c.select("c_custkey", F.when(ok, v.geo_fingerprint(F.col("c_acctbal") / 100, F.col("c_custkey") / 10)).otherwise("").alias("fp"))


@query("q_f09_identity", """WITH s AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN 'n/a' WHEN c_custkey % 2 = 0 THEN c_name END AS u, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS p FROM customer)
SELECT id, CASE WHEN lower(u) <> 'n/a' THEN u ELSE p END AS canonical_id, CASE WHEN lower(u) <> 'n/a' THEN 'unique' WHEN p IS NOT NULL THEN 'property' ELSE 'unresolved' END AS source,
CASE WHEN lower(u) <> 'n/a' THEN 1.0 WHEN p IS NOT NULL THEN 0.95 ELSE 0.0 END AS confidence FROM s""")
def identity(spark, d):
    k = F.col("c_custkey")
    s = table(spark, d, "customer").select(k.alias("id"), F.when(k % 5 == 0, "n/a").when(k % 2 == 0, F.col("c_name")).alias("u"), F.when(k % 3 == 0, F.col("c_mktsegment")).alias("p"))
    ident, source, confidence = v.identity({"unique": F.col("u"), "property": F.col("p")})
    return s.select("id", ident.alias("canonical_id"), source.alias("source"), confidence.alias("confidence"))


@query("q_f10_inferred_id", "SELECT p_partkey, CASE WHEN p_size > 0 THEN 'inferred_' || left(sha256(lower(trim(p_type)) || '|' || p_size || '|0|' || (round_even(p_retailprice / 10, 0) * 10)::BIGINT || '|' || (round_even(p_retailprice / 25, 0) * 25)::BIGINT), 12) END AS unit_id FROM part")
def inferred(spark, d):
    p = F.col("p_retailprice")
    return table(spark, d, "part").select("p_partkey", v.inferred_unit_id(F.col("p_type"), F.col("p_size"), F.lit(None).cast("string"), p, p).alias("unit_id"))


@query("q_f11_money", "SELECT l_orderkey, l_linenumber, trunc(l_extendedprice)::BIGINT AS money FROM lineitem")
def money(spark, d):
    text = F.concat(F.lit("$"), F.format_number("l_extendedprice", 2), F.lit(" / mo"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", v.money_to_int(text).alias("money"))


@query("q_f12_rent_range", "SELECT o_orderkey, CASE WHEN o_custkey BETWEEN 200 AND 50000 THEN o_custkey END AS a, nullif(greatest(CASE WHEN o_custkey BETWEEN 200 AND 50000 THEN o_custkey ELSE 0 END, CASE WHEN o_orderkey BETWEEN 200 AND 50000 THEN o_orderkey ELSE 0 END), 0)::BIGINT AS hi FROM orders")
def rent_range(spark, d):
    text = F.concat(F.lit("from $"), F.format_number("o_custkey", 0), F.lit(" to $"), F.format_number("o_orderkey", 0))
    one = F.concat(F.lit("$"), F.format_number("o_custkey", 0))
    return table(spark, d, "orders").select("o_orderkey", v.rent_low(one).alias("a"), v.rent_high(text).alias("hi"))


@query("q_f15_beds_baths", "SELECT p_partkey, greatest(0, least(7, p_size)) AS beds, greatest(0.0, least(10.0, round_even(p_retailprice / 100, 0) / 2)) AS baths, CASE WHEN floor(p_retailprice) BETWEEN 150 AND 10000 THEN floor(p_retailprice)::INT ELSE -1 END AS area FROM part")
def beds_baths(spark, d):
    return table(spark, d, "part").select("p_partkey", v.beds(F.col("p_size").cast("string")).alias("beds"), v.baths((F.col("p_retailprice") / 200).cast("string")).alias("baths"), v.area(F.col("p_retailprice").cast("string")).alias("area"))


@query("q_f19_dates", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS a, strftime(o_orderdate, '%Y-%m-%d') AS b FROM orders")
def dates(spark, d):
    """Two ways of writing the same day come back as the same ISO text."""
    o = table(spark, d, "orders")
    return o.select("o_orderkey", v.iso_date(F.date_format("o_orderdate", "MM/dd/yyyy")).alias("a"), v.us_date(F.date_format("o_orderdate", "M/d/yyyy")).alias("b"))


@query("q_f31_outcome", """SELECT event_id, CASE WHEN s BETWEEN 200 AND 299 THEN 'OK' WHEN s = 304 THEN 'NOT_MODIFIED' WHEN s = 407 THEN 'PROXY_ERROR' WHEN s = 429 THEN 'RATE_LIMITED' WHEN s BETWEEN 400 AND 499 THEN 'HARD_FAIL' ELSE 'TRANSIENT' END AS outcome
FROM (SELECT event_id, 200 + event_id % 400 AS s FROM events)""")
def outcome(spark, d):
    made = decisions.classify_response(200 + F.col("event_id") % 400, F.col("props"), F.lit(None).cast("string"))
    return table(spark, d, "events").select("event_id", made["outcome"].alias("outcome"))


@query("q_f23_availability", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'AVAILABLE' WHEN o_orderstatus = 'F' THEN 'UNAVAILABLE' ELSE 'UNKNOWN' END AS status FROM orders")
def availability(spark, d):
    text = F.when(F.col("o_orderstatus") == "O", "Available now").when(F.col("o_orderstatus") == "F", "Leased").otherwise("available June 1")
    return table(spark, d, "orders").select("o_orderkey", v.availability(text).alias("status"))


@query("q_p28_hash_sample", "SELECT doc_id FROM documents WHERE ('0x' || left(sha256(doc_id || '|2026-01-01'), 8))::BIGINT / 4294967295 < 0.075")
def sampled(spark, d):
    return table(spark, d, "documents").where(v.hash_sample(F.concat(F.col("doc_id").cast("string"), F.lit("|2026-01-01")))).select("doc_id")


@query("q_p20_junk", "SELECT doc_id, length(trim(text)) <= 1 OR lower(trim(text)) IN ('n/a', 'none', 'tba') AS junk FROM documents")
def junk(spark, d):
    t = F.trim("text")
    return table(spark, d, "documents").select("doc_id", ((F.length(t) <= 1) | F.lower(t).isin("n/a", "none", "tba")).alias("junk"))


@query("q_f25_text_scalars", r"SELECT doc_id, nullif(regexp_extract(text, '([0-9]+)', 1), '') AS first_number, len(regexp_extract_all(text, '[0-9]+')) AS n_numbers FROM documents")
def text_scalars(spark, d):
    return table(spark, d, "documents").select("doc_id", F.nullif(F.regexp_extract("text", "([0-9]+)", 1), F.lit("")).alias("first_number"), F.regexp_count("text", F.lit("[0-9]+")).cast("bigint").alias("n_numbers"))


@query("q_f14_bed_label", "SELECT p_partkey, CASE WHEN p_size % 4 = 0 OR contains(lower(p_name), 'studio') THEN 'Studio' ELSE (p_size % 4) || ' Bedroom' END AS label FROM part")
def labels(spark, d):
    return table(spark, d, "part").select("p_partkey", v.bed_label(F.col("p_size") % 4, F.col("p_name")).alias("label"))


@query("q_j12_substring_theta", "SELECT p_partkey, r.n AS pattern FROM part JOIN (VALUES ('ECO'), ('STAND'), ('ARG'), ('PROMO')) r(n) ON contains(upper(p_type), r.n) QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY r.n) = 1")
def substring_theta(spark, d):
    """First pattern contained, as a chain over the (small, given) pattern list: no join at all."""
    first = F.coalesce(*[F.when(F.contains(F.upper("p_type"), F.lit(p)), p) for p in ("ARG", "ECO", "PROMO", "STAND")])
    return table(spark, d, "part").select("p_partkey", first.alias("pattern")).where("pattern is not null")


@query("q_p01_first_alias", "SELECT c_custkey, CASE WHEN c_custkey % 4 > 0 THEN c_name ELSE n_name END AS name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def first_alias(spark, d):
    p = properties(spark, d)
    return p.select(F.col("id").alias("c_custkey"), v.first_clean(F.when(F.col("id") % 4 == 0, F.lit(" N/A ")).otherwise(F.col("name")), F.col("city")).alias("name"))
