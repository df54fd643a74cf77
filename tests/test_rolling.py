"""Trailing failure rates, maturity steps and link, retry and event rules against brute force and small cases."""

import random
import re

from pyspark.sql import functions as F

from leasegrid.functions import decisions
from leasegrid.operators import frames, rolling


def test_rolling_failures_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["hot", "hot", "hot", "b", None]), rng.choice([None, *range(0, 40)]), rng.choice([True, False, False, None])) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, k string, s long, bad boolean")
    got = {r.i: (r.n, r.errors, r.forced) for r in rolling.rolling_failures(df, "k", "s", "bad", 10, 0.4).collect()}

    def rate(k, s):
        near = [r for r in rows if r[1] == k and (r[2] is None if s is None else r[2] is not None and s - 10 <= r[2] <= s)]
        return len(near), sum(r[3] is True for r in near)

    def forced(k, s):
        times = {r[2] for r in rows if r[1] == k and (r[2] is None or (s is not None and r[2] <= s))}
        return any(e > 0.4 * n for n, e in (rate(k, t) for t in times))

    assert got == {i: (*rate(k, s), forced(k, s)) for i, k, s, _ in rows}
    assert rolling.rolling_failures(df.limit(0), "k", "s", "bad", 10, 0.4).count() == 0


def test_rolling_failures_need_no_frame_that_moves(spark):
    """Spark sums such a frame anew at each row: a key's work would grow with the square of its rows."""
    df = spark.createDataFrame([(1, "a", 1, True), (2, "a", 12, False)], "i int, k string, s int, bad boolean")
    got = rolling.rolling_failures(df, "k", "s", "bad", 10, 0.4)
    frames_used = set(re.findall(r"specifiedwindowframe\(([^()]*)", got._jdf.queryExecution().optimizedPlan().toString()))
    assert frames_used == {"RangeFrame, unboundedpreceding$"}
    assert sorted((r.i, r.n, r.errors, r.forced) for r in got.collect()) == [(1, 1, 1, True), (2, 1, 0, True)]


def test_maturity_steps_equal_a_fold(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abc"), i, rng.choice([True, True, False, False, None]), rng.choice([None, 1, 2, 3])) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, i int, ok boolean, tier int")
    want = {}
    state = {k: [0, 0, "COLD", None] for k in "abc"}
    for k, i, ok, tier in rows:
        s = state[k]
        if ok:
            s[0], s[1] = s[0] + 1, 0
            s[3] = tier if s[3] is None else s[3] if tier is None else min(s[3], tier)
        else:
            s[0], s[1] = 0, s[1] + 1
        s[2] = "HOT" if s[0] >= 3 else "WARM" if s[0] else "COLD" if s[1] >= 3 else s[2]
        want[i] = tuple(s)
    got = {r.i: (r.successes, r.failures, r.maturity, r.preferred_tier) for r in rolling.maturity_steps(df, "k", ["i"], F.col("ok"), F.col("tier")).collect()}
    assert got == want


def test_exploratory_links(spark):
    base = "https://www.home.com/start"
    cases = {
        "https://home.com/living": True, "https://home.com/contact": False, "https://home.com/contact-us": True, "https://home.com/x/gallery/1": False, "https://home.com/START": False, "https://home.com": False,
        "https://home.com/": False, "https://other.com/living": False, "https://home.com/floorplans": False, "https://home.com/a?page=contact": True, "https://home.com/amenit": False, "mailto:x": False, None: False,
    }
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    assert {r.u: r.x for r in df.select("u", decisions.exploratory_link(F.col("u"), F.lit(base)).alias("x")).collect()} == cases


def test_retry_and_smoke(spark):
    rows = [(1, "TIER_1", None, ["u"], None), (2, "failed", "ok", ["u"], []), (3, None, "Fail", ["u"], []), (4, "a", "b", [], []), (5, "a", "b", None, None), (6, "a", "b", ["u"], ["e"])]
    df = spark.createDataFrame(rows, "i int, tier string, verdict string, units array<string>, errors array<string>")
    test = decisions.needs_retry(*[F.col(c) for c in ("tier", "verdict", "units", "errors")])
    assert [r.i for r in df.where(test).orderBy("i").collect()] == [2, 3, 4, 5, 6]
    cols = ("outcome", "found", "units", "tier", "banner", "confidence")
    events = [("SUCCESS", True, 1, 5, True, 1.0), ("SKIPPED", True, 0, None, None, None), (None, None, None, None, None, None), ("SUCCESS", True, 0, 6, False, 1.5), ("SUCCESS", False, 0, 0, False, None)]
    df = spark.createDataFrame(events, "outcome string, found boolean, units int, tier int, banner boolean, confidence double")
    assert [r[0] for r in df.select(decisions.smoke_problems(*map(F.col, cols))).collect()] == [[], [], ["outcome", "missing output"], ["no units", "tier", "banner", "confidence"], ["missing output"]]


def test_property_issues(spark):
    rows = [(1, 5, "a", "12345"), (2, 0, " ", "1234"), (3, None, None, None), (4, -1, "b", "12345-1"), (5, 2, "", "")]
    df = spark.createDataFrame(rows, "k int, apartment_id int, name string, zip_code string")
    got = sorted((r.k, r.code.removeprefix("V2_"), r.field) for r in frames.property_issues_v2(df, "k", ("apartment_id", "name", "zip_code")).collect())
    required, zip_ = "MISSING_REQUIRED", "INVALID_ZIP"
    assert got == sorted([
        (2, "INVALID_APARTMENT_ID", "apartment_id"), (2, required, "name"), (2, zip_, "zip_code"), (3, required, "apartment_id"), (3, required, "name"), (3, required, "zip_code"),
        (4, "INVALID_APARTMENT_ID", "apartment_id"), (4, zip_, "zip_code"), (5, required, "name"), (5, required, "zip_code"), (5, zip_, "zip_code"),
    ])
