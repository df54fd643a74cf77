"""Payload and page extraction over bodies that Spark writes from the given line items, in each vendor's layout.

An order is one payload; its lines are the units. The SQL states what each layout's reader must give back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leasegrid.operators import html_units, lists, payloads, walk
from leasegrid.plans.tables import table, tasks

ALL: dict = {}
#: Order and line number are no key of the line items: what an order's lines are sorted by, in full.
ORDERED = ("line", "part", "unit", "sqft", "rent", "flag", "site", "day", "plan", "beds")
SHOWN = ("payload_id", "floor_plan_name", "bed_label", "sqft", "unit_number", "rent_range", "availability_status", "availability_date")
UNITS = """u AS (SELECT l_orderkey AS payload_id, l_linenumber AS line, l_partkey AS part, 'U' || l_linenumber || '-' || l_partkey AS unit, p_name AS plan, p_size % 4 AS beds,
  (l_quantity * 25)::BIGINT AS sqft, floor(l_extendedprice)::BIGINT AS rent, l_returnflag AS flag, l_linestatus AS site, strftime(l_shipdate, '%Y-%m-%d') AS day,
  CASE WHEN p_size % 4 = 0 OR contains(lower(p_name), 'studio') THEN 'Studio' ELSE (p_size % 4) || ' Bedroom' END AS label FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def query(name: str, sql: str | None = None):
    return lambda f: ALL.setdefault(name, (f, sql)) and f


def shown_sql(sqft: str = "sqft::VARCHAR", rent: str = "'$' || format('{:,}', rent)", status: str = "'AVAILABLE'", date: str = "''", rest: str = "FROM u") -> str:
    return f"WITH {UNITS} SELECT payload_id, plan AS floor_plan_name, label AS bed_label, {sqft} AS sqft, unit AS unit_number, {rent} AS rent_range, {status} AS availability_status, {date} AS availability_date {rest}"


# Bodies -----------------------------------------------------------------------------------------------------------------
def unit_lines(spark, d) -> DataFrame:
    """(payload_id, line, unit, part, plan, beds, sqft, rent, flag, site, day): a line item as a unit."""
    part = table(spark, d, "part").select(F.col("p_partkey").alias("part"), F.col("p_name").alias("plan"), (F.col("p_size") % 4).alias("beds"))
    lines = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("payload_id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), F.concat(F.lit("U"), "l_linenumber", F.lit("-"), "l_partkey").alias("unit"),
        (F.col("l_quantity") * 25).cast("bigint").alias("sqft"), F.floor("l_extendedprice").alias("rent"), F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("site"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"),
    )
    return lines.join(part, "part")


def dollars(c: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(c, 0))


def items(u: Column, *fields) -> Column:
    """The lines of an order, in order, as objects of the fields."""
    return F.transform(u, lambda x: F.struct(*[f(x) for f in fields]))


def named(key: str, make):
    """One field of items(): its key and how a line makes it."""
    return lambda x: make(x).alias(key)


def sightmap_body(u: Column) -> Column:
    units = items(
        u, named("unit_number", lambda x: x.unit), named("floor_plan_id", lambda x: x.part), named("price", lambda x: F.when(x.flag != "R", x.rent)), named("display_price", lambda x: dollars(x.rent)),
        named("area", lambda x: x.sqft), named("available_on", lambda x: x.day),
    )
    plans = F.array_distinct(items(u, named("id", lambda x: x.part.cast("string")), named("name", lambda x: x.plan), named("bedroom_count", lambda x: x.beds)))
    return F.to_json(F.struct(F.struct(units.alias("units"), plans.alias("floor_plans")).alias("data")))


def rentcafe_body(u: Column) -> Column:
    return F.to_json(items(
        u, named("floorplanName", lambda x: x.plan), named("floorplanId", lambda x: x.unit), named("beds", lambda x: x.beds.cast("string")), named("baths", lambda x: F.lit("1.5")),
        named("minimumSQFT", lambda x: x.sqft), named("maximumSQFT", lambda x: F.when(x.flag == "A", x.sqft + 100).otherwise(x.sqft)),
        named("minimumRent", lambda x: dollars(x.rent)), named("maximumRent", lambda x: dollars(x.rent + 100)), named("availableUnitsCount", lambda x: x.line - 1), named("availableDate", lambda x: x.day),
    ))


def entrata_body(u: Column) -> Column:
    plans = items(
        u, named("floorplan-name", lambda x: x.plan), named("no_of_bedroom", lambda x: x.beds), named("no_of_bathroom", lambda x: F.lit(1)), named("square_footage", lambda x: x.sqft),
        named("min_rent", lambda x: x.rent.cast("string")), named("max_rent", lambda x: dollars(x.rent)), named("id", lambda x: x.unit),
    )
    inner = plans
    for key in ("floor_plans", "floor_plans", "content", "widget_data"):
        inner = F.struct(inner.alias(key))
    return F.to_json(inner)


def appfolio_body(u: Column) -> Column:
    rent = named("rent", lambda x: F.struct(x.rent.alias("min"), (x.rent + 50).alias("max")))
    listed = items(u, named("name", lambda x: x.plan), named("bed", lambda x: x.beds), named("bath", lambda x: F.lit(1)), named("sq_ft", lambda x: x.sqft), rent, named("unit_number", lambda x: x.unit), named("available_date", lambda x: x.day), named("status", lambda x: F.when(x.flag == "R", "Leased").otherwise("Available")))
    return F.to_json(F.struct(listed.alias("objects")))


def onesite_body(u: Column) -> Column:
    plans = items(
        u, named("name", lambda x: x.plan), named("bedRooms", lambda x: x.beds.cast("string")), named("minimumSquareFeet", lambda x: x.sqft), named("maximumSquareFeet", lambda x: x.sqft + 10),
        named("minimumMarketRent", lambda x: x.rent + 0.5), named("maximumMarketRent", lambda x: x.rent + 20.5), named("id", lambda x: x.unit),
    )
    return F.to_json(F.struct(F.struct(plans.alias("floorplans")).alias("response")))


def generic_body(u: Column) -> Column:
    listed = items(u, named("planName", lambda x: x.plan), named("bd", lambda x: x.beds), named("size", lambda x: x.sqft), named("unitId", lambda x: x.unit), named("baseRent", lambda x: dollars(x.rent)), named("readyDate", lambda x: x.day))
    return F.to_json(F.struct(F.struct(listed.alias("listings")).alias("result")))


def orders(spark, d) -> DataFrame:
    """(payload_id, u): the lines of each order, in order of ORDERED; an order holds a few."""
    u = unit_lines(spark, d).repartition(tasks(spark), "payload_id")
    return u.groupBy("payload_id").agg(F.sort_array(F.collect_list(F.struct(*ORDERED))).alias("u"))


def orders_as(spark, d, body) -> DataFrame:
    """(payload_id, site, body): an order's body stays small, as its lines are few."""
    return orders(spark, d).select("payload_id", F.get("u", F.lit(0)).site.alias("site"), body(F.col("u")).alias("body"))


def read_back(spark, d, body, only: str) -> DataFrame:
    return payloads.unit_rows(orders_as(spark, d, body), only).select(*SHOWN)


# Queries ----------------------------------------------------------------------------------------------------------------
@query("q_x12_sightmap", shown_sql(date="day"))
def sightmap(spark, d):
    return read_back(spark, d, sightmap_body, "sightmap")


@query("q_x08_rentcafe", shown_sql("CASE WHEN flag = 'A' THEN sqft || '-' || (sqft + 100) ELSE sqft::VARCHAR END", "'$' || format('{:,}', rent) || ' - $' || format('{:,}', rent + 100)", "CASE WHEN line = 1 THEN 'UNAVAILABLE' ELSE 'AVAILABLE' END", "day"))
def rentcafe(spark, d):
    return read_back(spark, d, rentcafe_body, "rentcafe")


@query("q_x09_entrata", shown_sql())
def entrata(spark, d):
    return read_back(spark, d, entrata_body, "entrata")


@query("q_x10_appfolio", shown_sql(status="CASE WHEN flag = 'R' THEN 'LEASED' ELSE 'AVAILABLE' END", date="day"))
def appfolio(spark, d):
    return read_back(spark, d, appfolio_body, "appfolio")


@query("q_x11_onesite", shown_sql("sqft || '-' || (sqft + 10)", "'$' || format('{:,}', rent) || ' - $' || format('{:,}', rent + 20)"))
def onesite(spark, d):
    return read_back(spark, d, onesite_body, "onesite")


@query("q_x13_avalonbay", shown_sql(rent="'$' || format('{:,}', max(rent) OVER (PARTITION BY payload_id, beds))", date="day"))
def avalonbay(spark, d):
    """Units carry no rent; the order's summary holds one for each number of beds."""
    unit = F.struct(F.col("unit").alias("unitName"), F.col("beds").alias("bedroomNumber"), F.col("sqft").alias("squareFeet"), F.struct(F.col("plan").alias("name")).alias("floorPlan"), F.concat("day", F.lit("T00:00:00")).alias("availableDateUnfurnished"))
    by_beds = unit_lines(spark, d).groupBy("payload_id", "beds").agg(F.max("rent").alias("rent"), F.collect_list(unit).alias("units"))
    price = F.struct(F.col("beds").cast("string"), F.struct(F.col("rent").alias("unfurnished")))
    whole = by_beds.groupBy("payload_id").agg(F.flatten(F.collect_list("units")).alias("units"), F.map_from_entries(F.collect_list(price)).alias("totalPricesStartingAt"))
    bodies = whole.select("payload_id", F.to_json(F.struct("units", F.struct("totalPricesStartingAt").alias("unitsSummary"))).alias("body"))
    return payloads.unit_rows(bodies, "avalonbay").select(*SHOWN)



@query("q_x07_generic", f"""WITH {UNITS}, f AS (SELECT *, row_number() OVER (PARTITION BY payload_id, unit ORDER BY sqft, rent) AS turn FROM u)
SELECT payload_id, unit AS unit_number, '$' || format('{{:,}}', rent) AS rent_range, sqft::VARCHAR AS sqft FROM f WHERE turn = 1 AND rent BETWEEN 200 AND 50000""")
def generic(spark, d):
    """The first unit of equal numbers counts, and goes if its rent is impossible."""
    return read_back(spark, d, generic_body, "generic").select("payload_id", "unit_number", "rent_range", "sqft")


@query("q_x14_dispatch", f"WITH {UNITS} SELECT payload_id, CASE o_orderpriority WHEN '1-URGENT' THEN 'sightmap' WHEN '2-HIGH' THEN 'rentcafe' WHEN '3-MEDIUM' THEN 'entrata' WHEN '5-LOW' THEN 'onesite' ELSE 'appfolio' END AS layout, unit AS unit_number, label AS bed_label FROM u JOIN orders ON payload_id = o_orderkey")
def dispatch(spark, d):
    """Bodies in five layouts, told apart by their shape alone."""
    priorities = table(spark, d, "orders").select(F.col("o_orderkey").alias("payload_id"), F.col("o_orderpriority").alias("p"))
    x, p = F.col("u"), F.col("p")
    body = F.when(p == "1-URGENT", sightmap_body(x)).when(p == "2-HIGH", rentcafe_body(x)).when(p == "3-MEDIUM", entrata_body(x)).when(p == "5-LOW", onesite_body(x)).otherwise(appfolio_body(x))
    return payloads.unit_rows(orders(spark, d).join(priorities, "payload_id").select("payload_id", body.alias("body"))).select("payload_id", "layout", "unit_number", "bed_label")


@query("q_x21_mapping", f"WITH {UNITS} SELECT payload_id, unit AS unit_id, sqft, CASE WHEN flag <> 'R' AND rent BETWEEN 200 AND 50000 THEN rent::DOUBLE END AS market_rent_low, day AS available_date, 0.85::DOUBLE AS confidence FROM u")
def mapping(spark, d):
    """Replays saved field paths, one mapping a site; the mappings are a fixed, small table."""
    paths = {"unit_id": "unit_number", "rent_low": "price", "sqft": "area", "available_date": "available_on"}
    saved = spark.createDataFrame([("O", "data.units", paths), ("F", "data", paths)], "site string, envelope string, paths map<string,string>")
    return payloads.replay_mapping(orders_as(spark, d, sightmap_body), F.broadcast(saved), "site").select("payload_id", "unit_id", "sqft", "market_rent_low", "available_date", "confidence")


@query("q_x23_tolerant_json", "SELECT event_id, (props->>'k')::BIGINT AS k FROM events")
def tolerant(spark, d):
    answer = F.when(F.col("event_type") == "error", F.concat(F.lit("Here:\n```json\n"), "props", F.lit("\n```"))).when(F.col("event_type") == "click", F.col("props")).otherwise(F.concat(F.lit("It is "), "props", F.lit(" then")))
    return table(spark, d, "events").select("event_id", F.try_variant_get(payloads.tolerant_json(answer), "$.k", "bigint").alias("k"))


@query("q_x24_cascade", f"WITH {UNITS}, t AS (SELECT payload_id, unit, CASE flag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS tier FROM u) SELECT payload_id, unit, tier FROM t QUALIFY tier = min(tier) OVER (PARTITION BY payload_id)")
def cascade(spark, d):
    """Each order keeps the units of its first tier that has any."""
    tier = F.when(F.col("flag") == "R", 1).when(F.col("flag") == "A", 2).otherwise(3)
    return payloads.first_tier(unit_lines(spark, d).select("payload_id", "unit", tier.alias("tier")), "payload_id", "tier").select("payload_id", "unit", "tier")


@query("q_x25_tier_confidence", "SELECT l_orderkey AS payload_id, round(least(0.9, 0.7 + 0.03 * count(*)), 6)::DOUBLE AS confidence FROM lineitem GROUP BY 1")
def tier_confidence(spark, d):
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("payload_id")).agg(F.count(F.lit(1)).alias("n"))
    return lines.select("payload_id", F.round(payloads.tier_confidence(F.col("n"), 0.90, 0.7, 0.03), 6).alias("confidence"))


@query("q_x18_dom_units", f"SELECT payload_id AS page_id, left(unit, 11) AS unit_number, count(DISTINCT left(unit, 11))::INT AS n FROM (WITH {UNITS} FROM u) WHERE rent BETWEEN 200 AND 50000 GROUP BY 1, 2")
def dom(spark, d):
    """Which units a page of containers shows; equal numbers of one page are one unit."""
    card = lambda x: F.concat(F.lit('<div class="row"><div class="unit-card"><b>Unit '), x.unit, F.lit("</b> "), x.beds, F.lit(" bed<br>"), x.sqft, F.lit(" sq ft <i>"), dollars(x.rent), F.lit("</i></div></div>"))
    page = lambda u: F.concat(F.lit("<html><body><p>From $1,000"), F.array_join(F.transform(u, card), "\n"), F.lit("</body></html>"))
    pages = orders_as(spark, d, page).select(F.col("payload_id").alias("page_id"), F.col("body").alias("html"))
    return html_units.dom_units(pages).groupBy("page_id", "unit_number").agg(F.count(F.lit(1)).cast("int").alias("n"))


@query("q_x16_jsonld_units", f"WITH {UNITS} SELECT payload_id AS page_id, unit AS unit_number, rent::DOUBLE AS asking_rent, CASE WHEN flag = 'R' THEN 'UNAVAILABLE' ELSE 'AVAILABLE' END AS availability_status, sqft::INT AS sqft, plan AS floor_plan_type FROM u")
def jsonld(spark, d):
    offer = lambda x: F.struct(x.rent.alias("price"), F.when(x.flag == "R", "OutOfStock").otherwise("https://schema.org/InStock").alias("availability"))
    home = lambda x: F.struct(F.lit("Apartment").alias("@type"), x.unit.alias("name"), F.struct(x.sqft.cast("string").alias("value")).alias("floorSize"), x.plan.alias("accommodationCategory"), offer(x).alias("offers"))
    page = lambda u: F.concat(F.lit('<html><script type="application/ld+json">'), F.to_json(F.struct(F.lit("ApartmentComplex").alias("@type"), F.transform(u, home).alias("containsPlace"))), F.lit("</script></html>"))
    return html_units.jsonld_units(orders_as(spark, d, page).select(F.col("payload_id").alias("page_id"), F.col("body").alias("html")))


@query("q_x15_jsonld_offers", f"WITH {UNITS} SELECT payload_id AS page_id, plan AS floor_plan_name, beds::VARCHAR AS bedrooms, sqft::VARCHAR AS sqft, rent AS rent_low, rent + CASE flag WHEN 'R' THEN 50 WHEN 'A' THEN 100 ELSE 0 END AS rent_high, '$' || format('{{:,}}', rent) || CASE flag WHEN 'R' THEN ' - $' || format('{{:,}}', rent + 50) WHEN 'A' THEN ' - $' || format('{{:,}}', rent + 100) ELSE '' END AS rent_range FROM u")
def jsonld_offers(spark, d):
    """Plans with a list of offers, a range or one price, in a page that has a summary of all offers too."""
    of = lambda kind, **f: F.struct(F.lit(kind).alias("@type"), *[c.alias(k) for k, c in f.items()])
    offers = lambda x: F.parse_json(F.when(x.flag == "R", F.to_json(F.array(of("Offer", price=x.rent + 50), of("Offer", price=x.rent)))).when(x.flag == "A", F.to_json(of("AggregateOffer", lowPrice=x.rent, highPrice=dollars(x.rent + 100)))).otherwise(F.to_json(of("Offer", price=dollars(x.rent)))))
    plan = lambda x: of("FloorPlan", name=x.plan, numberOfRooms=x.beds, floorSize=F.struct(x.sqft.alias("value")), offers=offers(x))
    body = lambda u: F.to_json(of("ApartmentComplex", name=F.lit("A"), offers=F.array().cast("array<string>"), containsPlace=F.transform(u, plan), summary=of("AggregateOffer", lowPrice=F.lit(900))))
    page = lambda u: F.concat(F.lit('<html><script type="application/ld+json">'), body(u), F.lit("</script></html>"))
    return html_units.jsonld_offers(orders_as(spark, d, page).select(F.col("payload_id").alias("page_id"), F.col("body").alias("html")))


@query("q_x04_walked_units", f"WITH {UNITS} SELECT payload_id, unit AS unit_number, rent::DOUBLE AS asking_rent, CASE flag WHEN 'R' THEN 'UNAVAILABLE' WHEN 'A' THEN 'AVAILABLE' ELSE 'UNKNOWN' END AS availability_status, sqft::INT AS sqft, plan AS floor_plan_type FROM u")
def walked_units(spark, d):
    """Units two lists deep in a payload, beside objects that name none."""
    status = lambda x: F.when(x.flag == "R", "Leased").when(x.flag == "A", "Available now").otherwise("soon")
    unit = lambda x: F.struct(x.unit.alias("unitNumber"), dollars(x.rent).alias("marketRent"), status(x).alias("status"), x.sqft.alias("size"), x.plan.alias("floorPlan"), F.struct(x.line.alias("floor")).alias("place"))
    body = lambda u: F.to_json(F.struct(F.struct(F.array(F.transform(u, unit)).alias("groups"), F.lit(1).alias("total")).alias("result")))
    return walk.walked_units(orders_as(spark, d, body))


@query("q_x05_listed_units", f"""WITH {UNITS}, big AS (SELECT l_orderkey AS payload_id FROM lineitem GROUP BY 1 HAVING count(*) >= 3)
SELECT payload_id, unit AS unit_id, rent AS market_rent_low, CASE flag WHEN 'R' THEN rent + 40 ELSE rent END AS market_rent_high, day AS available_date, CASE WHEN sqft > 100 THEN sqft END AS sqft, plan AS floor_plan, beds::VARCHAR AS bedrooms
FROM u JOIN big USING (payload_id) WHERE rent BETWEEN 200 AND 50000""")
def listed(spark, d):
    """Rents as nested amounts, as lists of terms or plain; lists of fewer than three are no units, nor are lists without rents."""
    u = unit_lines(spark, d)
    rent = lambda x: F.parse_json(F.when(x.flag == "R", F.to_json(F.struct(dollars(x.rent).alias("min"), (x.rent + 40).alias("max")))).otherwise(F.to_json(F.transform(F.array(x.rent + 9, x.rent), lambda r: F.struct(r.alias("rent"))))))
    size = lambda x: F.parse_json(F.when(x.sqft > 100, F.to_json(F.struct(x.sqft.alias("v"))).substr(F.lit(6), F.length(x.sqft.cast("string")))).otherwise(F.lit('"small"')))
    unit = lambda x: F.struct(x.unit.alias("unitId"), rent(x).alias("rent"), size(x).alias("area"), x.day.alias("moveInDate"), x.plan.alias("floorPlanName"), x.beds.alias("beds"), F.transform(F.array(F.lit(1), F.lit(2)), lambda i: F.struct(i.alias("id"), F.lit(900).alias("price"))).alias("fees"))
    body = lambda us: F.to_json(F.struct(F.transform(us, lambda x: F.struct(x.unit.alias("id"))).alias("menu"), F.struct(F.array(F.transform(us, unit)).alias("pages")).alias("out")))
    return lists.listed_units(orders_as(spark, d, body))


@query("q_x06_broad", f"""WITH {UNITS}, f AS (SELECT o_custkey AS site, u.*, row_number() OVER (PARTITION BY o_custkey, CASE WHEN flag = 'N' THEN unit ELSE plan || '|' || beds || '|' || sqft || '|' || CASE WHEN flag = 'A' THEN '' ELSE '$' || format('{{:,}}', rent) END END ORDER BY payload_id, line, part, unit, sqft, rent, flag, site, day, plan, beds) AS turn FROM u JOIN orders ON payload_id = o_orderkey),
s AS (SELECT site, flag, plan AS floor_plan_name, CASE WHEN beds = 0 THEN 'Studio' ELSE beds || ' Bedroom' END AS bed_label, sqft::VARCHAR AS sqft, CASE WHEN flag = 'N' THEN unit ELSE '' END AS unit_number, CASE WHEN flag = 'A' THEN '' ELSE '$' || format('{{:,}}', rent) END AS rent_range, CASE WHEN flag = 'R' THEN 'AVAILABLE' ELSE '' END AS availability_status FROM f WHERE turn = 1)
SELECT * EXCLUDE (flag) FROM s WHERE flag <> 'A' OR site NOT IN (SELECT site FROM s WHERE flag <> 'A')""")
def broad(spark, d):
    """All payloads of a customer are one site; A lines have neither number nor rent and only count where a site has nothing better."""
    one = lambda x: F.struct(x.plan.alias("title"), x.beds.alias("num_bedrooms"), x.sqft.alias("displayArea"), F.when(x.flag == "N", x.unit).alias("unitCode"), F.when(x.flag != "A", dollars(x.rent)).alias("starting_rent"), F.when(x.flag == "R", 2).otherwise(0).alias("units_available"))
    body = lambda u: F.to_json(F.struct(F.lit("ok").alias("state"), F.struct(F.struct(F.transform(u, one).alias("Apartments")).alias("results")).alias("response")))
    made = orders_as(spark, d, body).select(F.col("payload_id").alias("seq"), "body")
    sites = table(spark, d, "orders").select(F.col("o_orderkey").alias("seq"), F.col("o_custkey").alias("site"))
    found = lists.broad_units(made.join(sites, "seq").select("site", "seq", F.lit("api.example.com").alias("host"), "body"))
    return found.select("site", "floor_plan_name", "bed_label", "sqft", "unit_number", "rent_range", "availability_status")


@query("q_k13_run_report", """WITH t AS (SELECT ts::DATE AS run, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT run, '# Run ' || run || chr(10) || chr(10) || '| Type | Events |' || chr(10) || '|-|-|' || chr(10) || string_agg('| ' || event_type || ' | ' || n || ' |', chr(10) ORDER BY n DESC, event_type) AS markdown FROM t GROUP BY 1""")
def run_report(spark, d):
    """A Markdown report for each run, written by the executors; a run has few types."""
    t = table(spark, d, "events").groupBy(F.to_date("ts").alias("run"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    lines = F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("k"), "event_type", "n"))), lambda x: F.concat(F.lit("| "), x.event_type, F.lit(" | "), x.n, F.lit(" |")))
    head = F.concat(F.lit("# Run "), F.col("run").cast("string"), F.lit("\n\n| Type | Events |\n|-|-|\n"))
    return t.groupBy("run").agg(lines.alias("_lines")).select("run", F.concat(head, F.array_join("_lines", "\n")).alias("markdown"))
