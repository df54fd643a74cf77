"""Formats, retries, validated records, metrics, readers by provider and kinds of payloads, at their boundaries."""

import datetime

from pyspark.sql import functions as F

from leasegrid.functions import formats
from leasegrid.operators import frames, outcomes


def values(spark, kind, xs, *made):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], f"i int, x {kind}").orderBy("i")
    rows = df.select("i", *[m(F.col("x")).alias(f"c{k}") for k, m in enumerate(made)]).orderBy("i").collect()
    return [[r[f"c{k}"] for r in rows] for k in range(len(made))]


def test_formats(spark):
    money, two, cost, number, percent, duration = values(
        spark, "double", [None, 0.0, 0.0049, 0.5, 1234.5, -2.5, 61.0, 3725.4], formats.currency, lambda x: formats.currency(x, 2), formats.cost, formats.number, formats.percent, formats.duration
    )
    assert money == ["—", "$0", "$0", "$1", "$1,235", "-$3", "$61", "$3,725"] and two[4:6] == ["$1,234.50", "-$2.50"]
    assert cost[:5] == ["—", "$0.00", "$0.0049", "$0.500", "$1,234.50"] and number == ["—", "0", "0.005", "0.5", "1,234.5", "-2.5", "61", "3,725.4"]
    assert percent[:5] == ["—", "0.0%", "0.5%", "50.0%", "123450.0%"] and duration[:5] == ["—", "0s", "0s", "1s", "20m 35s"] and duration[6:] == ["1m 1s", "1h 2m"]
    assert values(spark, "bigint", [0, 1023, 1024, 1536, 1 << 20, None], formats.size)[0] == ["0B", "1023B", "1.0KB", "1.5KB", "1.0MB", None]
    short, name = values(spark, "string", ["", "abcdef", "abcdefg", None, "É a/b-c_1"], lambda x: formats.shortened(x, 6), lambda x: formats.file_name(x, 7))
    assert short == ["", "abcdef", "abc...", None, "É a..."] and name == ["", "abcdef", "abcdefg", None, "É_a_b-c"]
    now = datetime.datetime(2026, 3, 10, 12)
    ago = [now - datetime.timedelta(**d) for d in ({"hours": 23}, {"hours": 24}, {"days": 6}, {"days": 7}, {"days": 20})]
    relative, long = values(spark, "timestamp", [*ago, None], lambda x: formats.date(x, "relative", F.lit(now)), lambda x: formats.date(x, "long"))
    assert relative == ["Today", "Yesterday", "6d ago", "1w ago", "2w ago", "—"] and long[1] == "March 9, 2026" and long[-1] == "—"


def test_retries(spark):
    cases = [
        ("OK", 1, None, False, 0, False), ("HARD_FAIL", 1, None, False, 0, False), ("TRANSIENT", 3, None, False, 0, False), ("RATE_LIMITED", 1, None, True, 5000, False), ("RATE_LIMITED", 2, " 7 ", True, 7000, False),
        ("RATE_LIMITED", 1, "0", True, 1000, False), ("RATE_LIMITED", 1, "soon", True, 5000, False), ("RATE_LIMITED", 3, "7", False, 0, False), ("BOT_BLOCKED", 2, None, False, 0, False),
    ]
    df = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(cases)], "i int, o string, a int, r string")
    got = {r["i"]: tuple(r["x"]) for r in df.select("i", outcomes.retry(F.col("o"), F.col("a"), F.col("r"), F.col("i")).alias("x")).collect()}
    assert got == {i: c[3:] for i, c in enumerate(cases)}
    drawn = spark.range(2000).select(outcomes.retry(F.lit("PROXY_ERROR"), F.lit(2), F.lit(None).cast("string"), F.col("id")).alias("x")).select("x.*").collect()
    waits = [r["wait_ms"] for r in drawn]
    assert all(r["should_retry"] and r["rotate_identity"] for r in drawn) and 750 <= min(waits) < 760 and 1240 < max(waits) < 1250 and len(set(waits)) > 300


def test_validated_records(spark):
    units = spark.createDataFrame(
        [("p", "1", 1000.0, 700.0, "A"), ("p", "2", -5.0, 700.0, "A"), ("p", "3", 1000.0, 99999.0, "A"), ("q", "1", 1600.0, 700.0, "b "), ("q", None, 10.0, 5.0, None)], "prop string, unit_id string, rent double, sqft double, floor_plan_name string"
    )
    history = spark.createDataFrame([("q", "1", 1000.0, 700.0, "B"), ("p", "2", 1.0, 1.0, "A")], "prop string, unit_id string, rent double, area double, plan string")
    got = {(r["prop"], r["rent"], r["sqft"]): (r["status"], r["reasons"], r["flags"], r["next_tier"]) for r in outcomes.validated(units, history, "prop").collect()}
    assert got["p", 1000.0, 700.0] == ("accepted", [], [], True) and got["p", -5.0, 700.0][:3] == ("rejected", ["INVALID_RENT_NEGATIVE"], [])
    assert got["q", 1600.0, 700.0] == ("flagged", [], ["rent_swing_>50pct"], False) and got["q", 10.0, 5.0][0] == "rejected"


def test_daily_metrics_of_nothing(spark):
    empty = spark.createDataFrame([], "property_id long, ts timestamp, outcome string, tier int, domain string, vision boolean, banner boolean, page_load_ms double")
    got = {r["metric"]: (r["value"], r["ok"]) for r in outcomes.daily_metrics(empty, F.lit("2026-01-02").cast("timestamp")).collect()}
    assert got["properties"] == (0.0, False) and got["vision_rate"] == (0.0, True) and got["bad_domains"] == (0.0, True) and got["p95_page_load_ms"] == (0.0, True)


def test_readers_by_provider(spark):
    names = ["rentcafe", " Entrata", "realpage_oll", "wix_nopms", "custom", None, "none of these"]
    df = spark.createDataFrame([(n,) for n in names], "p string").select("p", outcomes.reader_of(F.col("p")).alias("r"))
    got = {r["p"]: r["r"] for r in df.collect()}
    assert [got[n]["reader"] for n in names] == ["rentcafe", "entrata", "onesite", None, "generic", "generic", "generic"] and got["wix_nopms"]["tier"] == "SYNDICATION_ONLY_WIX" and got["custom"]["error"] is None


def test_body_kinds(spark):
    bodies = ['{"b": 1, "a": [2]}', '[{"x": 1}, 2]', "[]", "[1, 2]", '"text"', "3", "2.5", "true", "null", "{half", None]
    got = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, b string").select("i", outcomes.body_kind(F.col("b")).alias("k")).orderBy("i").collect()
    assert [r["k"]["kind"] for r in got] == ["dict (keys: ['a', 'b'])", "list[dict] (2 items, keys: ['x'])", "list (0 items)", "list (2 items)", "str", "int", "float", "bool", "null", "null", "null"]
    assert [r["k"]["preview"] for r in got][:6] == ["{a, b...}", "[{x...}] (2 items)", "[...] (0 items)", "[...] (2 items)", "text", "3"]


def test_places_in_a_sorted_table(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 > 0, (F.col("id") * 7919) % 101).alias("v")).repartition(7)
    got = frames.placed(df, "place", F.col("v").desc_nulls_last(), F.col("id").asc()).collect()
    want = sorted(((r["id"], r["v"]) for r in got), key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert [(r["id"], r["v"]) for r in sorted(got, key=lambda r: r["place"])] == want and sorted(r["place"] for r in got) == list(range(1, 1001))
    assert frames.placed(df.limit(0), "place", F.col("id").asc()).count() == 0
