"""Runs across roots, seed files, reports and saved documents."""

import gzip

import pytest
from pyspark.sql import functions as F

from leasegrid.sources import runs


def test_property_lists(spark, tmp_path):
    (tmp_path / "p.csv").write_text("﻿Property ID,PROPERTY URL,Property Type,PMS Platform,Extra,ZIP\n7, http://a ,Lease Up,RentCafe,x,\n8,,Stabilized,,,1\n,http://c,,,,\n9,http://b,other,,,00123\n", encoding="utf-8")
    got = sorted(map(tuple, runs.read_properties(spark, str(tmp_path / "p.csv")).collect()))
    assert got == [("7", "http://a", "LEASE_UP", "rentcafe", None, None, None), ("9", "http://b", "STABILISED", None, "00123", None, None)]
    (tmp_path / "e.csv").write_text("note\nx\n")
    assert runs.read_properties(spark, str(tmp_path / "e.csv")).count() == 0
    (tmp_path / "s.csv").write_text("Unique ID,Website\n1,http://b\n1,http://a\n2,\n,http://c\n")
    assert [tuple(r) for r in runs.id_urls(spark, str(tmp_path / "s.csv")).collect()] == [("1", "http://a")]


def test_runs_across_roots(spark, tmp_path):
    base = str(tmp_path)
    assert runs.latest_run(spark, base) is None and runs.read_roots(spark, base, "units") is None
    with pytest.raises(FileNotFoundError):
        runs.latest_name(spark, base + "/runs")
    for at in ("runs/2026-01-02", "v1/runs/2026-01-03", "v2/runs/2026-01-03", "v2/runs/zz-not-a-run"):
        (tmp_path / at).mkdir(parents=True)
    assert runs.latest_run(spark, base) == f"{base}/v1/runs/2026-01-03"
    assert runs.latest_name(spark, base + "/v2/runs") == "zz-not-a-run"
    assert runs.root_of(spark, base, "v2", "runs") == f"{base}/v2/runs" and runs.root_of(spark, base, "v3", "runs") == f"{base}/runs"
    spark.range(2).write.parquet(base + "/runs/units")
    spark.range(3).withColumn("beds", F.lit(1)).write.parquet(base + "/v2/runs/units")
    both = runs.read_roots(spark, base, "units")
    assert {(r["_root"], r["beds"]) for r in both.collect()} == {("runs", None), ("v2/runs", 1)} and both.count() == 5


def test_reports_and_documents(spark, tmp_path):
    run = tmp_path / "runs/2026-01-02"
    (run / "property_reports").mkdir(parents=True)
    (tmp_path / "runs/2026-01-03").mkdir()
    (run / "property_reports/a.md").write_text("**Extraction Tier:** `T1`\n| Units Extracted | 12 |\n| LLM Calls Made | 3 |\n| LLM Total Cost | $0.25 |\n\n## Errors\n\n1. first one\n2. next\n")
    (run / "property_reports/b.md").write_text("nothing")
    got = sorted(map(tuple, runs.read_property_reports(spark, str(run)).collect()))
    assert got == [("a", "T1", 12, 3, 0.25, "first one"), ("b", None, None, None, None, None)]
    (run / "note.md").write_text("x\ny")
    assert [(str(r[0]), r[1]) for r in runs.newest_text(spark, str(tmp_path / "runs"), "note.md").collect()] == [("2026-01-02", "x\ny")]
    assert runs.newest_text(spark, str(tmp_path / "runs"), "none.md") is None
    assert runs.first_report(spark, str(run)) is None
    for n in ("report_b.json", "report.json", "other.json"):
        (run / n).write_text("{}")
    assert runs.first_report(spark, str(run)) == f"{run}/report.json"
    docs = tmp_path / "docs"
    docs.mkdir()
    assert runs.read_documents(spark, str(docs), "maturity string").count() == 0
    (docs / "p1.json").write_text('{"maturity":\n "HOT"}')
    (docs / "p2.json").write_text("{broken")
    assert [tuple(r) for r in runs.read_documents(spark, str(docs), "maturity string").where("maturity = 'HOT'").collect()] == [("HOT", "p1")]
    (tmp_path / "raw/2026-01-02").mkdir(parents=True)
    (tmp_path / "raw/2026-01-02/p1.html.gz").write_bytes(gzip.compress(b"<p>1</p>\n<p>2</p>"))
    (tmp_path / "raw/2026-01-02/p2.html.gz").write_bytes(gzip.compress(b"x"))
    events = spark.createDataFrame([("p1", "extract.tier_won", 1, "T3"), ("p1", "extract.tier_won", 2, "T1"), ("p1", "other", 3, "x")], "property_id string, kind string, ts int, data string")
    pages = runs.read_replay(spark, str(tmp_path / "raw"), "2026-01-02")
    assert sorted(map(tuple, runs.replay(pages, events).collect())) == [("p1", "<p>1</p>\n<p>2</p>", 2, "T1"), ("p2", "x", None, None)]


def test_sitemap_lastmod(spark):
    body = "<URL><loc> http://h/a/b </loc>\n<lastmod>d1</lastmod></URL><url><loc>http://h/a/b</loc><lastmod>d2</lastmod></url><url><loc>http://h/c</loc></url>"
    df = spark.createDataFrame([("http://h/a/b", body), ("http://other/c", body), ("http://h", body), ("http://h/x", None)], "url string, body string")
    assert [r[0] for r in df.select(runs.sitemap_lastmod(F.col("url"), F.col("body"))).collect()] == ["d1", None, None, None]
