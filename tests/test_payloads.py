"""Payload and page extraction against small bodies of every layout."""

import json

import pytest
from pyspark.sql import functions as F

from leasegrid.operators import html_units, payloads, walk

BODIES = {
    "sightmap": {"data": {"units": [
        {"id": 1, "unit_number": "101", "floor_plan_id": 7, "price": 1450, "area": 700, "available_on": "2026-01-05"},
        {"id": 2, "label": "102", "floor_plan_id": "8", "price": 0, "display_price": "$1,600", "display_area": " 800 sq "},
        {"id": 3, "unit_number": "103", "floor_plan_id": 99},
    ], "floor_plans": [{"id": 7, "name": "Old", "bedroom_count": 2}, {"id": 7, "name": "Aspen", "bedroom_count": 1, "bathroom_count": 1}, {"id": "8", "filter_label": "The Studio", "bedroom_count": None}]}},
    "rentcafe": [
        {"floorplanName": "B1", "floorplanId": "77", "beds": "2", "baths": "1.5", "minimumSQFT": "900", "maximumSQFT": "950", "minimumRent": "$1,500", "maximumRent": "$1,700", "availableUnitsCount": "3"},
        {"floorplanName": "B2", "floorplanId": "78", "beds": "0", "min_price": 0, "minimumRent": "$900", "maximumRent": "$990", "availableUnitsCount": "0"},
    ],
    "entrata": {"widget_data": {"content": {"floor_plans": {"floor_plans": [{"floorplan-name": "C", "no_of_bedroom": 3, "no_of_bathroom": 2, "square_footage": 1200, "min_rent": "2000", "max_rent": "2000", "id": 5}]}}}},
    "appfolio": {"objects": [{"name": "D", "bed": 1, "bath": 1, "sq_ft": 650, "rent": {"min": 1100, "max": 1200}, "unit_number": "D4", "status": "Leased"}, "no object"]},
    "onesite": {"response": {"floorplans": [{"name": "E", "bedRooms": "2", "bathRooms": "x", "minimumSquareFeet": 700, "maximumSquareFeet": 700, "minimumMarketRent": 1300.9, "maximumMarketRent": 1500, "id": 9, "depositAmount": 250}]}},
    "avalonbay": {"units": [{"unitName": "A-1", "bedroomNumber": 1, "bathroomNumber": 1, "squareFeet": 720, "floorPlan": {"name": "F"}, "availableDateUnfurnished": "2026-02-03T00:00:00", "promotions": [{"promotionTitle": "Gift"}]}],
                  "unitsSummary": {"totalPricesStartingAt": {"1": {"unfurnished": 2100.5}}}},
    "generic": {"result": {"listings": [
        {"planName": "G", "bd": 1, "size": 500, "unitId": "Left", "baseRent": "1,200"}, {"planName": "G", "bd": 1, "size": 500, "unitId": "s", "baseRent": "1,200"},
        {"planName": "MODULE_X", "baseRent": 900}, {"planName": "H", "baseRent": 99}, {"color": "red"}, {"planName": "I", "bedBath": "1x1", "unitId": "I9"},
    ]}},
}
WANT = {
    "sightmap": [("Aspen", "1 Bedroom", "1", "700", "101", "$1,450"), ("The Studio", "Studio", "", "800 sq", "102", "$1,600"), ("", "", "", "", "103", "")],
    "rentcafe": [("B1", "2 Bedroom", "2", "900-950", "77", "$1,500 - $1,700"), ("B2", "Studio", "0", "", "78", "$990")],
    "entrata": [("C", "3 Bedroom", "3", "1200", "5", "$2,000")],
    "appfolio": [("D", "1 Bedroom", "1", "650", "D4", "$1,100")],
    "onesite": [("E", "2 Bedroom", "2", "700", "9", "$1,300 - $1,500")],
    "avalonbay": [("F", "1 Bedroom", "1", "720", "A-1", "$2,100")],
    "generic": [("G", "1 Bedroom", "1", "500", "", "$1,200"), ("I", "1x1", "", "", "I9", "")],
}
SHOWN = ("floor_plan_name", "bed_label", "bedrooms", "sqft", "unit_number", "rent_range")


def frame(spark, bodies):
    return spark.createDataFrame([(k, b if isinstance(b, str) or b is None else json.dumps(b)) for k, b in bodies.items()], "payload_id string, body string")


def rows(df):
    found = {}
    for r in df.orderBy("payload_id", "pos").collect():
        found.setdefault(r["payload_id"], []).append(tuple(r[c] for c in SHOWN))
    return found


def test_layouts_are_told_and_read(spark):
    df = payloads.unit_rows(frame(spark, BODIES | {"broken": "{", "empty": "", "none": None, "list": "[]", "number": "3"})).cache()
    assert {r[0] for r in df.where("payload_id <> layout").collect()} == set()
    assert rows(df) == WANT


@pytest.mark.parametrize("only", sorted(BODIES))
def test_one_layout(spark, only):
    assert rows(payloads.unit_rows(frame(spark, {only: BODIES[only]}), only)) == {only: WANT[only]}


def test_other_fields(spark):
    got = {r["payload_id"]: r for r in payloads.unit_rows(frame(spark, {k: BODIES[k] for k in ("appfolio", "avalonbay", "onesite", "entrata")})).collect()}
    assert got["appfolio"]["availability_status"] == "LEASED"
    assert (got["avalonbay"]["availability_date"], got["avalonbay"]["concession"]) == ("2026-02-03", "Gift")
    assert (got["onesite"]["deposit"], got["onesite"]["bathrooms"], got["entrata"]["available_units"]) == ("250", "", "1")


def test_answers_and_mappings(spark):
    from pyspark.sql import functions as F

    texts = ['{"a": 1}', 'so:\n```json\n{"a": 2}\n```', 'well {"a": 3} done', "nothing", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.try_variant_get(payloads.tolerant_json(F.col("t")), "$.a", "int"))
    assert [r[0] for r in df.collect()] == [1, 2, 3, None, None]
    body = {"d": [{"inner": {"units": [{"k": {"id": "u1"}, "r": ["150", "1500"]}, {"k": {}, "r": ["1"]}, 5]}}]}
    got = payloads.replay_mapping(
        frame(spark, {"p": body, "q": {"d": []}}).withColumn("site", F.lit("s")),
        spark.createDataFrame([("s", "d.0.inner", {"unit_id": "k.id", "rent_low": "r.0", "rent_high": "r.1", "availability_status": "k.none"})], "site string, envelope string, paths map<string,string>"), "site",
    ).collect()
    assert [(r["payload_id"], r["unit_id"], r["market_rent_low"], r["market_rent_high"], r["availability_status"], r["confidence"]) for r in got] == [("p", "u1", None, 1500.0, "UNKNOWN", 0.85)]


PAGE = """<html><head><script type="application/ld+json">{"@type": "ApartmentComplex", "containsPlace": [
{"@type": "Apartment", "name": "A1", "floorSize": {"value": "750"}, "accommodationCategory": "1BR", "offers": {"price": "1500", "availability": "https://schema.org/InStock"}},
{"@type": ["Thing", "Apartment"], "identifier": "A2", "offers": [{"price": 1600.5, "availability": "OutOfStock"}]}]}</script>
<script type="application/ld+json">{broken</script></head><body><p>From $1,000</p>
<div class="unit-card big"><b>Unit 12B</b><br>1 bed, 1.5 bath<img src="x"> 640 sq ft <i>$1,250</i></div>
<div class="unit-card">Unit 12B again 2 bed $1,350</div><div class="unit-card">Studio from $900 to $1,100</div>
<div class="unit-card">Deposit $500 only</div><div class="card floorplan">2 bed $1,999 700 sqft</div></body></html>"""


def test_pages(spark):
    df = spark.createDataFrame([(1, PAGE), (2, ""), (3, None), (4, "<div class=unit-row>2 br $1,700"), (5, "<div class='unit-card'>1 bed $700</div>" * 81)], "page_id int, html string")
    dom = html_units.dom_units(df).orderBy("page_id", "pos").collect()
    assert [(r["page_id"], r["unit_number"], r["rent_low"], r["rent_high"], r["sqft"], r["bed_label"], r["bathrooms"]) for r in dom] == [
        (1, "12B", 1250, 1250, "640", "1BR", "1.5"), (1, "", 900, 1100, "", "Studio", ""), (4, "", 1700, 1700, "", "2BR", ""),
    ]
    ld = html_units.jsonld_units(df).orderBy("unit_number").collect()
    assert [tuple(r) for r in ld] == [(1, "A1", 1500.0, "AVAILABLE", 750, "1BR"), (1, "A2", 1600.5, "UNAVAILABLE", None, None)]


def test_ranked_links(spark):
    html = (
        "<a href='/floor-plans/'>See</a><a class=x href=\"/about\">About us</a><a href='tel:1'>rent</a><a href='https://x.rentcafe.com/a'>Apply <b>now</b></a>"
        "<a href='https://else.org/units'>units</a><a href='/floor-plans/'>Floor  Plan</a><a href='rent'>Go</a><a href='//www.h.org/units'>go</a><a href='/x/p'>apartment</a>"
    )
    df = spark.createDataFrame([(1, "https://h.org/x/p", html), (2, "https://h.org", None), (3, None, html), (4, "https://h.org", "")], "page_id long, url string, html string")
    got = [tuple(r) for r in html_units.ranked_links(df).where("page_id < 3").orderBy("page_id", "place").collect()]
    assert got == [
        (1, "https://h.org/floor-plans/", 185, "floor plan", 1),
        (1, "https://x.rentcafe.com/a", 150, "apply now", 2),
        (1, "https://www.h.org/units", 85, "go", 3),
        (1, "https://h.org/x/rent", 60, "go", 4),
    ]
    # A page without an address has no site of its own; only portals are left.
    assert [r["href"] for r in html_units.ranked_links(df).where("page_id = 3").collect()] in ([], ["https://x.rentcafe.com/a"])


def test_jsonld_of_any_depth(spark):
    inner = '{"@type": "Apartment", "name": "deep [}", "note": "a \\" ] }"}'
    for k in range(25):
        inner = '{"a": [' + inner + "]}" if k % 2 else '{"@type": "T", "b": ' + inner + "}"
    page = lambda s: f'<script type="application/ld+json">{s}</script>'
    df = spark.createDataFrame([(1, page(inner) + page("[") + page("7")), (2, None), (3, page('"@type"')), (4, page('[{"@type": "Apartment", "name": "top"}]'))], "page_id long, html string")
    assert sorted(map(tuple, html_units.jsonld_nodes(df).groupBy("page_id").count().collect())) == [(1, 14), (4, 1)]
    assert sorted(r["unit_number"] for r in html_units.jsonld_units(df).collect()) == ["deep [}", "top"]
    assert html_units.jsonld_nodes(df.where("page_id = 2")).count() == 0


def test_jsonld_offers(spark):
    blocks = (
        '{"@type": "ApartmentComplex", "name": "all"}',
        '{"@type": ["AggregateOffer"], "lowPrice": 1}',
        '{"@type": "Offer", "price": 900}',
        '{"@type": "Apartment"}',
        '{"@type": "Apartment", "name": "n"}',
        '{"@type": ["Thing", "FloorPlan"], "numberOfRooms": {"value": 2}, "offers": [{"price": "x"}, {"price": 0, "lowPrice": "$1,100.90"}, {"price": 900}]}',
        '{"@type": "Residence", "floorSize": 700, "offers": {"highPrice": 1500}}',
        '{"@type": "Residence", "name": "r", "offers": {"price": 1200, "highPrice": "1200"}}',
    )
    df = spark.createDataFrame([(1, "".join(f'<script type="application/ld+json">{b}</script>' for b in blocks)), (2, None)], "page_id long, html string")
    assert sorted(map(tuple, html_units.jsonld_offers(df).drop("page_id").collect()), key=repr) == sorted([
        ("n", "", "", None, None, ""), ("", "2", "", 900, 1100, "$900 - $1,100"), ("", "", "700", None, 1500, ""), ("r", "", "", 1200, 1200, "$1,200"),
    ], key=repr)


def test_units_anywhere(spark):
    body = '{"unit": "", "name": "A", "rent": "1.2.3", "kids": [[{"unitNumber": 7, "rent": "$1,200.50", "available": true, "size": "700.9 sq"}, {"rent": 5}], {"unit": "B", "rent": 0, "price": 9, "status": "unavailable soon", "type": "1x1"}, 3, null]}'
    df = spark.createDataFrame([(1, body), (2, "{broken"), (3, None), (4, "[]"), (5, '{"name": "solo", "status": "avail. soon"}')], "payload_id long, body string")
    assert sorted(map(tuple, walk.walked_units(df).collect()), key=repr) == sorted([
        (1, "A", None, None, None, None), (1, "7", 1200.5, "AVAILABLE", 700, None), (1, "B", 0.0, "UNAVAILABLE", None, "1x1"), (5, "solo", None, "AVAILABLE", None, None),
    ], key=repr)


def test_deep_texts_make_no_longer_plans(spark):
    deep = '{"unit": "end", "rent": 5}'
    for k in range(500):
        deep = '{"a": ' + deep + "}" if k % 2 else "[" + deep + ", 1]"
    df = spark.range(2000).selectExpr("id AS payload_id", "concat('{\"unit\": \"u', id, '\", \"rent\": 7}') AS body")
    both = df.unionByName(spark.createDataFrame([(-1, deep), (-2, "[" * 100_000), (-3, '{"unit": 1, "unit": 2}')], "payload_id long, body string"))
    plan = lambda x: len(walk.walked_units(x)._jdf.queryExecution().toString())
    assert plan(both) < plan(df) + 2000
    got = walk.walked_units(both)
    assert got.count() == 2001 and [r["unit_number"] for r in got.where("payload_id < 0").collect()] == ["end"]


def test_values_that_are_kept_are_not_written_on_every_level(spark):
    nested = '{"unit": "x", "next": null}'
    for k in range(300):
        nested = f'{{"unit": "{k}", "next": {nested}}}'
    df = spark.createDataFrame([(1, nested)], "payload_id long, body string")
    sizes = walk.every_node(df, "body", wanted=lambda x: isinstance(x, dict)).selectExpr("length(to_json(node)) AS n").collect()
    assert len(sizes) == 301 and max(r["n"] for r in sizes) < 200


def test_a_container_text_is_read_once(spark):
    """The filter that follows must not have the patterns matched again; pages with too many containers of a kind or without any give none."""
    card = '<div class="unit-card apartment">Unit {} 2 bed 1 bath 700 sq ft $1,200 to $1,500</div>'
    pages = [(1, card.format("A1") + card.format("A2") + card.format("A1")), (2, card.format("A") * 81), (3, "<p>none</p>"), (4, ""), (5, None)]
    got = html_units.dom_units(spark.createDataFrame(pages, "page_id long, html string"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert [plan.count(p) for p in (html_units.SQFT, html_units.BATHS, html_units.UNIT_NUMBER, html_units.RENT)] == [1] * 4
    assert sorted((r.page_id, r.pos, r.unit_number, r.rent_low, r.rent_high, r.sqft, r.bedrooms, r.bathrooms) for r in got.collect()) == [(1, 0, "A1", 1200, 1500, "700", "2", "1"), (1, 3, "A2", 1200, 1500, "700", "2", "1")]


def test_objects_that_are_no_home_are_not_written_again(spark):
    """Offers go before they leave the walk, and of homes only what is read is handed on; types as lists are left to the plan."""
    body = '{"@type": "ApartmentComplex", "name": "A", "containsPlace": [{"@type": "FloorPlan", "name": "P", "photo": "x", "offers": {"@type": "Offer", "price": "1000"}}, {"@type": ["Offer"], "name": "o"}], "s": {"@type": "AggregateOffer"}}'
    pages = spark.createDataFrame([(1, f'<script type="application/ld+json">{body}</script>')], "page_id long, html string")
    got = sorted(r[0] for r in html_units.jsonld_nodes(pages, ("Offer", "AggregateOffer"), ("@type", "name", "offers")).selectExpr("to_json(node)").collect())
    assert got == ['{"@type":"ApartmentComplex","name":"A"}', '{"@type":"FloorPlan","name":"P","offers":{"@type":"Offer","price":"1000"}}', '{"@type":["Offer"],"name":"o"}']
    assert [(r.floor_plan_name, r.rent_low) for r in html_units.jsonld_offers(pages).collect()] == [("P", 1000)]


def test_paths_of_generic_lists_are_literals(spark, monkeypatch):
    """A path that is no literal is parsed for every body; the first list of objects still counts."""
    bodies = ['[{"unitId": "a1", "rent": 900}]', '{"units": [1], "items": [{"unitId": "b1", "rent": 900}]}', '{"result": {"listings": [{"unitId": "c1", "rent": 900}]}, "data": [{"unitId": "d1", "rent": 900}]}', '{"units": [], "body": {"units": null}}', "no", None]
    df = spark.createDataFrame(list(enumerate(bodies)), "payload_id int, body string")
    got = payloads.unit_rows(df, "generic")
    asked, real = [], F.try_variant_get
    monkeypatch.setattr(payloads.F, "try_variant_get", lambda value, path, kind: asked.append(path) or real(value, path, kind))
    payloads._generic_list(F.col("body"))
    assert asked and all(isinstance(path, str) for path in asked)
    assert sorted((r.payload_id, r.unit_number) for r in got.collect()) == [(0, "a1"), (1, "b1"), (2, "d1")]
