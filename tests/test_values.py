"""Boundary values of scalar rules, sources, sinks, operators and streams."""

import datetime

import pytest
from pyspark.sql import functions as F

from leasegrid.functions import values as v
from leasegrid.operators import frames
from leasegrid.sources import files
from leasegrid.streaming import events as streams


def one(spark, rule, *rows):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], f"i int, x {'string' if all(isinstance(x, str | None) for x in rows) else 'double'}")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("x"))).collect()]


@pytest.mark.parametrize(
    ("rule", "given", "want"),
    [
        (v.beds, ["studio", "S", "", "2.7", "-1", "9", None], [0, 0, None, 2, 0, 7, None]),
        (v.baths, ["1.25", "1.75", "11", "x"], [1.0, 2.0, 10.0, None]),
        (v.area, ["149", "150", "10000", "10001", "-1", None], [-1, 150, 10000, -1, -1, -1]),
        (v.zip_any, ["8854", "08854-1234", "TX 78701", ""], ["08854", "08854", "78701", None]),
        (v.money_to_int, ["$1,234.99", "$1,200-$1,500", "1.2.3", "none"], [1234, 12001500, None, None]),
        (v.rent_low, ["$1,200 - $1,500", "199", "50000", "50001"], [1200, None, 50000, None]),
        (v.iso_date, ["13/02/2026", "02/13/2026", "2026/02/13", "2026-02-13T10:00:00", "2026-99-99", "x"], ["2026-02-13", "2026-02-13", "2026-02-13", "2026-02-13", "2026-99-99", None]),
        (v.us_date, ["1/2/26", "12/31/2026", "nope"], ["2026-01-02", "2026-12-31", None]),
        (v.host, ["https://WWW.Ab.com:80/x?y", "ab.com/x", ""], ["ab.com:80", "ab.com", ""]),
        (v.address, ["12 North Main Street, Apt. 4"], ["12 n main st apt 4"]),
        (v.availability, ["Available", "available June 1", "Unavailable", "Leased", "y", "0", "?", None], ["AVAILABLE", "UNKNOWN", "UNAVAILABLE", "UNAVAILABLE", "AVAILABLE", "UNAVAILABLE", "UNKNOWN", None]),
        (v.mask_credentials, ["http://u:p@h/x"], ["http://***@h/x"]),
        (v.clean, [" N/A ", "null", " a ", ""], [None, None, "a", None]),
        (v.half_up, [2.5, -2.5, 1.4], [3.0, -2.0, 1.0]),
        (v.half_even, [2.5, 3.5, -2.5], [2.0, 4.0, -2.0]),
    ],
)
def test_scalar_boundaries(spark, rule, given, want):
    assert one(spark, rule, *given) == want


@pytest.mark.parametrize(("xs", "median", "p50", "near"), [([], 0.0, None, None), ([1.0], 1.0, 1.0, 1.0), ([1.0, 2.0], 2.0, 2.0, 1.0), ([3.0, 1.0, 2.0], 2.0, 2.0, 2.0)])
def test_three_percentile_rules(spark, xs, median, p50, near):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = df.agg(v.upper_median(F.col("x")), v.index_percentile(F.col("x"), 0.5), v.nearest_percentile(F.col("x"), 50)).first()
    assert tuple(got) == (median, p50, near)


def test_swing_is_strict_at_20_and_50(spark):
    df = spark.createDataFrame([(1200.0, 1000.0), (1500.0, 1000.0), (1501.0, 1000.0), (1201.0, 1000.0), (5.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(v.swing_flag(F.col("a"), F.col("b"))).collect()] == [None, "rent_swing_gt_20pct", "rent_swing_gt_50pct", "rent_swing_gt_20pct", None]


def test_geo_rejects_bad_places(spark):
    df = spark.createDataFrame([(0.0, 0.0), (91.0, 1.0), (1.0, -181.0), (1.5, 2.25)], "a double, b double")
    assert [r[0] for r in df.select(v.geo_fingerprint(F.col("a"), F.col("b"))).collect()] == ["", "", "", "geo_1.5000_2.2500"]


def test_diff_covers_both_sides_and_merge_and_dedup_are_idempotent(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k long, x string")
    b = spark.createDataFrame([(2, "c"), (3, None), (4, "d")], "k long, x string")
    got = {r["k"]: r["change"] for r in frames.snapshot_diff(a, b, ["k"], ["x"]).collect()}
    assert got == {1: "disappeared", 2: "updated", 3: "unchanged", 4: "new"}
    merged = frames.override_merge(a, b, "k")
    assert sorted(map(tuple, frames.override_merge(merged, b, "k").collect()), key=repr) == sorted(map(tuple, merged.collect()), key=repr)
    twice = spark.createDataFrame([("x", 1), ("x", 0), ("", 2), (None, 3)], "key string, pos int")
    once = frames.first_wins(twice, F.col("key"), F.col("pos"))
    assert [tuple(r) for r in once.collect()] == [("x", 0)] == [tuple(r) for r in frames.first_wins(once, F.col("key"), F.col("pos")).collect()]
    carried = frames.carry_forward(a.withColumn("carried", F.lit(2)), b, ["k"])
    assert {r["k"]: r["carried"] for r in carried.collect()} == {1: 3, 2: 0, 3: 0, 4: 0}


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "seed.csv").write_text('﻿Unique ID,Website,Note\n7,http://a.com,"x ""q"""\nn/a,,\n', encoding="utf-8")
    assert [tuple(r) for r in files.read_seed(spark, str(tmp_path / "seed.csv")).collect()] == [("7", "http://a.com"), (None, "")]
    (tmp_path / "l.jsonl").write_text('{"a": 1}\nbroken\n{"a": 2}\n')
    assert sorted(r["a"] for r in files.read_json_lines(spark, str(tmp_path / "l.jsonl"), "a long").collect()) == [1, 2]
    (tmp_path / "x.json").write_text('[{"a": 1}, {"a": 3}]')
    assert files.read_json_array(spark, str(tmp_path / "x.json"), "a long").count() == 2
    assert files.read_json_array(spark, str(tmp_path / "none.json"), "a long").count() == 0
    (tmp_path / "s.xml").write_text("<urlset><url><loc> http://a/1 </loc><priority>0.5</priority></url><url><loc>http://a/2</loc></url></urlset>")
    assert [tuple(r) for r in files.read_sitemap(spark, str(tmp_path / "s.xml")).orderBy("loc").collect()] == [("http://a/1", None, 0.5), ("http://a/2", None, None)]
    root = str(tmp_path / "runs")
    for day, n in (("2026-01-01", 2), ("2026-01-02", 3), ("2026-01-02", 4)):
        files.write_run(spark.range(n), root, day)
    assert files.runs(spark, root) == ["2026-01-02", "2026-01-01"]
    assert files.read_run(spark, root).count() == 4 and files.read_run(spark, root, "2026-01-01").count() == 2
    with pytest.raises(FileNotFoundError):
        files.read_run(spark, str(tmp_path / "no"))
    files.export_csv(spark.createDataFrame([("a\"b", None)], "x string, y string").coalesce(1), str(tmp_path / "out"))
    assert next((tmp_path / "out").glob("part-*")).read_text().splitlines()[1].startswith('"a""b"')
    old = spark.createDataFrame([("u", "d1", 3, "seed")], "url string, first_seen string, depth int, source string")
    new = spark.createDataFrame([("u", "d2", 1, "map"), ("w", "d2", 5, "map")], "url string, first_seen string, depth int, source string")
    assert sorted(map(tuple, files.upsert_frontier(old, new).collect())) == [("u", "d1", 1, "map"), ("w", "d2", 5, "map")]
    aged = spark.createDataFrame([("2026-01-01",), ("2026-01-31",), ("x",)], "d string")
    assert sorted(r[0] for r in files.keep_recent(aged, "d", "2026-02-15").collect()) == ["2026-01-31", "x"]


def test_streams_equal_batch(spark, tmp_path):
    path = "/root/testdata/sf0.001/events.parquet"
    batch = spark.read.parquet(path)
    batch.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    q = streams.failure_rates(stream, late="60 days").writeStream.format("memory").queryName("rates").outputMode("update").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination(180)
    got = {r["first"]: (r["n"], r["errors"]) for r in spark.table("rates").orderBy("n").collect()}
    want = {r["first"]: (r["n"], r["errors"]) for r in streams.failure_rates(batch).collect()}
    assert got == want
    q = streams.failure_streaks(stream).writeStream.format("memory").queryName("streaks").outputMode("update").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination(180)
    got = {r["user_id"]: (r["n_events"], r["streak"]) for r in spark.table("streaks").collect()}
    s = frames.streaks(batch, ["user_id"], F.col("event_type") == "error", F.col("ts"), F.col("event_id"))
    want = {r["user_id"]: (r["n"], r["s"]) for r in s.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max_by("streak", F.struct("ts", "event_id")).alias("s")).collect()}
    assert got == want
    assert isinstance(next(iter(streams.failure_rates(batch).collect()))["first"], datetime.datetime)
