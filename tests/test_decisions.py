"""Boundary cases of the decision rules."""

import datetime

import pytest
from pyspark.sql import functions as F

from leasegrid.functions import decisions
from leasegrid.operators import frames, html_units


def rows(spark, rule, schema, *given):
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(given)], f"i int, {schema}")
    return [tuple(r[0]) if hasattr(r[0], "asDict") else r[0] for r in df.orderBy("i").select(rule).collect()]


def test_response_classes(spark):
    rule = decisions.classify_response(F.col("s"), F.col("b"), F.col("e"))
    got = rows(
        spark, rule, "s int, b string, e string",
        (None, None, None), (200, "", "ValueError"), (None, "", "ValueError"), (403, "x __cf_chl_ y", None), (403, None, None), (418, "", None), (599, "", None), (302, "", None), (200, "", "SSLError"), (None, None, "gaierror"),
    )
    assert got == [
        ("TRANSIENT", "no_response"), ("OK", None), ("TRANSIENT", "ValueError"), ("BOT_BLOCKED", "CF_CHALLENGE"), ("HARD_FAIL", "HTTP_403"), ("HARD_FAIL", "HTTP_418"),
        ("TRANSIENT", "HTTP_599"), ("TRANSIENT", "HTTP_302"), ("HARD_FAIL", "ERR_SSL_PROTOCOL_ERROR"), ("HARD_FAIL", "ERR_DNS"),
    ]


def test_fetch_mode_limits(spark):
    rule = decisions.fetch_mode(F.lit(False), F.col("d"), F.col("m"), F.lit(None).cast("date"), F.lit(None).cast("date"))
    got = rows(spark, rule, "d int, m string", (None, "HOT"), (7, None), (8, "WARM"), (0, "HOT"), (1, "HOT"), (2, "WARM"), (3, "WARM"))
    assert [r[1] for r in got] == ["stale_render_7d", "default_render", "stale_render_7d", "hot_profile_fresh", "default_render", "warm_profile_static", "default_render"]


def test_retry_turns_daily_at_six_hours(spark):
    t = datetime.datetime(2026, 1, 1)
    h = lambda n: t + datetime.timedelta(seconds=n)
    got = rows(spark, decisions.next_retry(F.col("p"), F.col("n")), "p timestamp_ntz, n timestamp_ntz", (t, h(5 * 3600 + 59 * 60)), (t, h(6 * 3600)))
    assert got == [h(6 * 3600 + 59 * 60), h(30 * 3600)]


def test_drift(spark):
    rule = decisions.drift(F.col("m"), F.col("x"), F.col("n"), F.col("r"), F.col("t"), F.col("f"))
    got = rows(spark, rule, "m string, x int, n int, r int, t boolean, f int", ("HOT", 10, 7, 0, False, 0), ("HOT", 10, 6, 0, False, 0), ("COLD", 10, 0, 0, True, 9), ("WARM", 10, 9, 9, False, 0), ("WARM", 0, 0, 0, True, 2), ("WARM", 0, 0, 0, None, 2))
    assert got == [([], "HOT"), (["unit_count_drop"], "WARM"), ([], "COLD"), (["all_rents_null"], "COLD"), (["timeout_pattern"], "COLD"), ([], "WARM")]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Available Now", None), ("Avail 6/5/26", "2026-06-05"), ("Jun 15", "2026-06-15"), ("sept. 3, 2027", "2027-09-03"), ("2/30/2026", None), ("soon", None), ("", None), (None, None),
    ],
)
def test_dates_in_texts(spark, text, want):
    got = frames.with_text_facts(spark.createDataFrame([(text,)], "t string"), "t", 2026).first()["availability_date"]
    assert (got and got.isoformat()) == want


def test_facts_of_empty_texts(spark):
    df = spark.createDataFrame([(0, None), (1, ""), (2, "1.5 bd"), (3, "$0 apt 12B waitlist")], "i int, t string")
    got = [tuple(r) for r in frames.with_text_facts(df, "t", 2026).orderBy("i").drop("i", "t").collect()]
    empty = (None, None, None, None, None, "UNKNOWN", None, None)
    assert got[:2] == [empty, empty]
    assert got[2][3] == "1.5 Bed"
    assert got[3][:2] == ("12B", None) and got[3][5] == "UNAVAILABLE"


def test_provider_ties_and_votes(spark):
    given = [
        (None, None, None, None), ("https://a.rentcafe.com/x", "wix.com", None, None), ("https://notrentcafe.com/", "", "", ""), ("https://x.live.com/a.aspx", None, None, None),
        ("https://v.com/a.aspx", None, "mark-taylor", None), ("https://v.com/a.aspx", "YARDI", "Lindsey Management", None),
    ]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(given)], "i int, u string, p string, c string, h string")
    got = [tuple(r["provider"]) for r in frames.with_provider(df, "u", "p", "c", "h").orderBy("i").collect()]
    assert [(n, round(c, 10)) for n, c in got] == [("unknown", 0.0), ("rentcafe", 0.95), ("unknown", 0.0), ("unknown", 0.0), ("rentcafe", 0.70), ("rentcafe", 0.95)]


def test_links(spark):
    rule = decisions.absolute_url(F.lit("https://www.Ab.com/x/y?q"), F.col("h"))
    got = rows(spark, rule, "h string", ("#a",), ("mailto:x",), ("/p",), ("p",), ("?z",), ("//cdn.com/a",), ("http://ab.com/k",), ("http://m.ab.com/k",), ("http://other.com",), ("ftp://ab.com",), ("",), (None,))
    site = "https://www.Ab.com"
    assert got == [None, None, f"{site}/p", f"{site}/x/p", f"{site}/x/y?z", "https://cdn.com/a", "http://ab.com/k", "http://m.ab.com/k", None, None, None, None]


def test_embedded_json(spark):
    unit = '{"unit":"' + "x" * 300 + '"}'
    pages = [
        (0, None), (1, ""), (2, "<p>units</p>"),
        (3, f"<SCRIPT ID=a TYPE='application/json'>[{unit}]</SCRIPT>"),
        (4, f"<script type=\"application/json\">{'[1]'}</script>"),
        (5, f'<script src="/x.js">var units = {unit};</script>'),
        (6, f"<script>/* rent */ let list = [{unit}]; var rest = {{a: {unit}}};</script>"),
        (7, f'<script type="module">var units = {unit};</script>'),
    ]
    got = html_units.embedded_json(spark.createDataFrame(pages, "page_id int, html string")).collect()
    assert sorted((r["page_id"], r["url"]) for r in got) == [(3, "embedded:json-block:a"), (6, "embedded:script-var:list")]


def test_migration_without_lists(spark):
    old = "api_hints struct<api_provider string, blocked_endpoints array<string>, llm_field_mappings array<string>>, dom_hints struct<platform_detected string, other int>, navigation struct<entry_url string, explored_links array<string>>, cluster_id int"
    given = [((None, None, None), ("x", 1), (None, None), 1), (None, None, None, None)]
    got = frames.migrate_profiles(spark.createDataFrame(given, old)).collect()
    assert [r["version"] for r in got] == [2, 2]
    assert got[0]["api_hints"]["api_provider"] == "unknown" and got[0]["dom_hints"].asDict() == {"other": 1} and got[0]["last_success_detection"] is None
    assert "cluster_id" not in got[0].asDict() and got[1]["api_hints"] is None
