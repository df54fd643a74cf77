"""Pattern joins, bounded windows, stores, sinks, requests and change detection on small tables with their odd cases."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from leasegrid.operators import patterns, requests, rolling
from leasegrid.sources import documents, files
from leasegrid.streaming import probes, sink


# Patterns ---------------------------------------------------------------------------------------------------------
TEXTS = ["https://a.com/api/units?x=1", "https://a.com/api", "short", "", None, "aaaaaaaaaaaa", "ünïcode/päth", "https://b.org/other", "a.com"]
SAVED = [("a.com/api", 5), ("/api/units", 3), ("aaaaaaa", 9), ("päth", 1), ("ort", 7), ("", 0), (None, 0), ("a.com", 3), ("a.com", 8), ("nowhere at all", 2), ("x=", 3)]


@pytest.mark.parametrize("most", [0, 1 << 20])
@pytest.mark.parametrize("both_ways", [False, True])
def test_first_match_equals_brute_force(spark, most, both_ways):
    texts = spark.createDataFrame([(i, t, 1) for i, t in enumerate([*TEXTS, *TEXTS])], "id int, text string, _left int")
    saved = spark.createDataFrame(SAVED, "pattern string, place int")

    def best(text):
        hits = [(n, p) for p, n in SAVED if p and text and (p in text or (both_ways and text in p))]
        return min(hits)[::-1] if hits else (None, None)

    got = {r["id"]: (r["pattern"], r["place"]) for r in patterns.first_match(texts, saved, both_ways, most).collect()}
    assert got == {i: best(t) for i, t in enumerate([*TEXTS, *TEXTS])}
    assert patterns.first_match(texts, saved.limit(0), both_ways, most).where("pattern is not null").count() == 0


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_block_lists(spark, most):
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, text string")
    blocked = spark.createDataFrame([("https://a.com/api",), ("ünï",), ("",), (None,)], "pattern string")
    kept = lambda substrings: sorted(r["id"] for r in patterns.unblocked(texts, blocked, substrings, most).collect())
    assert kept(False) == [0, 2, 3, 4, 5, 6, 7, 8] and kept(True) == [2, 3, 4, 5, 7, 8]


# Windows ----------------------------------------------------------------------------------------------------------
def test_last_attempts_equal_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, "hot", rng.randrange(8 * 86_400) // 40 * 40, rng.random() < 0.03) for i in range(5000)] + [(9000 + i, "b", i * 200_000, i == 1) for i in range(9)]
    rows += [(9100, None, 5, True), (9101, "c", None, True), (9102, "d", 7, None)]
    df = spark.createDataFrame(rows, "id long, domain string, s long, bad boolean").repartition(4)
    want, ever = {}, {}
    for domain in ("hot", "b", "d"):
        mine = sorted((r for r in rows if r[1] == domain), key=lambda r: (r[2], r[0]))
        for k, r in enumerate(mine):
            near = [x for x in mine[max(0, k - 1999) : k + 1] if x[2] >= r[2] - 604_800]
            errors = sum(bool(x[3]) for x in near)
            ever[domain] = ever.get(domain, False) or errors > 0.035 * len(near)
            want[r[0]] = (len(near), errors, ever[domain])
    got = {r["id"]: (r["n"], r["errors"], r["forced"]) for r in rolling.last_attempts(df, "domain", "s", "id", "bad", 604_800, 2000, 0.035).collect()}
    assert got == want | {9100: (None, None, None), 9101: (None, None, None)}


# Documents --------------------------------------------------------------------------------------------------------
def docs(spark, *rows):
    return spark.createDataFrame(rows, "id string, body string")


def test_documents_keep_every_version(spark, tmp_path):
    store = documents.DocumentStore(spark, str(tmp_path / "s"), "id")
    assert store.current() is None and store.save(docs(spark, ("a", "1"), ("b", "1"), (None, "x"))) == 1
    store.save(docs(spark, ("a", "2"), ("a", "3"), ("c", "1")))
    assert sorted((r["id"], r["body"], r["version"]) for r in store.current().collect()) == [("a", "3", 3), ("b", "1", 1), ("c", "1", 1)]
    assert sorted((r["id"], r["body"], r["version"], r["saved"]) for r in store.audit().collect()) == [("a", "1", 1, 1), ("a", "2", 2, 2), ("a", "3", 3, 2), ("b", "1", 1, 1), ("c", "1", 1, 2)]


def test_of_two_writers_one_wins(spark, tmp_path):
    store, other = (documents.DocumentStore(spark, str(tmp_path / "s"), "id") for _ in range(2))
    store.save(docs(spark, ("a", "1")))
    base = other.begin()
    store.save(docs(spark, ("a", "mine")))
    with pytest.raises(documents.Conflict):
        other.save(docs(spark, ("a", "theirs")), base)
    assert [r["body"] for r in store.current().collect()] == ["mine"]
    # What lost is in no manifest; it saves again on what is there now.
    other.save(docs(spark, ("a", "theirs")))
    assert [(r["body"], r["version"]) for r in store.current().collect()] == [("theirs", 3)]


def test_a_corrupt_manifest_is_moved_aside(spark, tmp_path):
    store = documents.DocumentStore(spark, str(tmp_path / "s"), "id")
    store.save(docs(spark, ("a", "1")))
    store.save(docs(spark, ("a", "2")))
    at = tmp_path / "s" / "manifest"
    (at / ".v00000002.crc").unlink(missing_ok=True)
    (at / "v00000002").write_text("[half")
    assert [r["body"] for r in store.current().collect()] == ["1"] and (at / "v00000002.corrupt.0").exists()
    assert store.save(docs(spark, ("a", "3"))) == 3 and [(r["body"], r["version"]) for r in store.current().collect()] == [("3", 2)]


def test_objects_are_written_whole(spark, tmp_path):
    path = f"{tmp_path}/state.json"
    assert documents.read_object(spark, path) is None
    documents.write_text(spark, path, '{"a": 1}')
    documents.write_text(spark, path, '{"a": 2}')
    assert documents.read_object(spark, path) == {"a": 2} and [n for n in files.names(spark, str(tmp_path)) if not n.startswith(".")] == ["state.json"]
    with pytest.raises(documents.Conflict):
        documents.write_text(spark, path, "{}", replace=False)


def test_retention_by_name(spark, tmp_path):
    for name in ("run_date=2026-01-01", "run_date=2026-01-31", "2025-12-31.html", "notes", "run_date=soon", "2026-02-01.png", "2026-13-01"):
        (tmp_path / name).mkdir()
    # The day of the cutoff itself stays.
    assert sorted(files.drop_old(spark, str(tmp_path), "2026-03-02", 30)) == ["2025-12-31.html", "run_date=2026-01-01"]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["2026-02-01.png", "2026-13-01", "notes", "run_date=2026-01-31", "run_date=soon"]
    assert files.drop_old(spark, f"{tmp_path}/none", "2026-03-02") == []


# Events -----------------------------------------------------------------------------------------------------------
def test_delivery_once_and_dead_letters(spark, tmp_path):
    rows = [(1, "2026-01-01 00:00:00", "view", '{"a": 1}'), (2, "2026-01-01 00:00:00", "view", "{broken"), (None, "2026-01-01 00:00:00", "view", None), (4, None, "view", None), (5, "2026-01-01 00:00:00", "", None), (6, "2026-01-01 00:00:00", "view", None)]
    df = spark.createDataFrame(rows, "event_id long, ts string, event_type string, props string").withColumn("ts", F.col("ts").cast("timestamp"))
    df.repartition(2).write.parquet(f"{tmp_path}/in")
    stream = lambda: spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    root = f"{tmp_path}/out"
    sink.deliver(stream(), root, f"{tmp_path}/check", sink.event_trouble).awaitTermination()
    read = lambda name: spark.read.parquet(f"{root}/{name}")
    assert sorted(r["event_id"] for r in read("events").collect()) == [1, 6]
    assert sorted(r["trouble"] for r in read("dead").collect()) == ["no id", "no kind", "no time", "payload is no object"]
    # A restart finds nothing new, and the batch that runs again replaces itself.
    sink.deliver(stream(), root, f"{tmp_path}/check", sink.event_trouble).awaitTermination()
    sink.write_batch(df, 0, root, sink.event_trouble(df))
    assert sorted(r["event_id"] for r in read("events").collect()) == [1, 6] and read("dead").count() == 4


# Requests ---------------------------------------------------------------------------------------------------------
def test_requests_are_data(spark):
    rows = [(1, "O'Hara; DROP TABLE x --", "A,B", "S"), (2, "plain", "C", "S"), (3, "PLAIN two", None, "T"), (4, None, "C", "T"), (5, ":size", "C", "U")]
    df = spark.createDataFrame(rows, "id int, name string, city string, status string")
    ids = lambda **p: [r["id"] for r in requests.property_page(df, p).collect()]
    assert ids() == [1, 2, 3, 4, 5] and ids(search="o'hara; drop") == [1] and ids(search="' OR 1=1 --") == [] and ids(search=":size") == [5] and ids(search="plain") == [2, 3]
    assert ids(city="C", status="S,T") == [2, 4] and ids(city="A,B") == [] and ids(sort="city", dir="desc") == [2, 4, 5, 1, 3] and ids(page="2", pageSize="2") == [3, 4] and ids(page="9") == []
    assert requests.property_page(df, {"pageSize": "1"}).first()["total"] == 5
    for bad in ({"page": "0"}, {"page": "x"}, {"page": "1.5"}, {"pageSize": "101"}, {"dir": "up"}, {"sort": "id; DROP"}, {"page": "nan"}):
        with pytest.raises(requests.BadRequest):
            requests.property_page(df, bad)


# Change detection -------------------------------------------------------------------------------------------------
def at(day, hour=0):
    return datetime.datetime(2026, 1, day, hour, tzinfo=datetime.UTC)


def rows_of(*tags):
    """(property, time, status, etag, last_modified, sitemap, api)"""
    return [(1, at(d), s, e, None, m, a) for d, s, e, m, a in tags]


def test_change_detection_rules():
    known, said = None, []
    for r in rows_of((1, 200, "x", "m1", None), (2, 304, None, None, None), (3, 200, "x", "m1", None), (4, 200, "x", "m2", None), (5, 200, None, None, None), (6, 200, "y", "", ""), (7, 200, "y", None, None), (14, 200, "y", "m2", None)):
        decision, known = probes.step(dict(zip(probes.PROBE, r, strict=True)), known)
        said.append((decision[5], decision[6], decision[7], decision[8]))
    assert said == [
        (False, True, 0, "CHANGED"), (True, False, 1, "UNCHANGED"), (True, False, 2, "UNCHANGED"), (False, False, 0, "CHANGED"), (False, False, 0, "INCONCLUSIVE"),
        (False, False, 0, "CHANGED"), (True, False, 1, "UNCHANGED"), (False, True, 0, "INCONCLUSIVE"),
    ]


def test_stream_of_probes_equals_batch_and_restarts(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    schema = "property_id long, ts timestamp, status int, etag string, last_modified string, sitemap_lastmod string, api_hash string"
    rng = random.Random(3)
    rows = sorted(((p, at(1 + k // 3, rng.randrange(24)), rng.choice([200, 200, 304]), rng.choice(["e1", "e2", None]), None, rng.choice(["m", None]), rng.choice(["h", "h", "g"])) for p in range(5) for k in range(30)), key=lambda r: r[1])
    # A property that is not probed again.
    rows.insert(0, (9, at(1), 200, "e", None, None, None))
    df = spark.createDataFrame(rows, schema)
    out = f"{tmp_path}/out"

    def run(part):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = probes.decisions(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), late="2 days")
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{tmp_path}/check").outputMode("append").trigger(availableNow=True).start().awaitTermination()

    third = len(rows) // 3
    for part in (rows[:third], rows[third : 2 * third], rows[2 * third :]):
        run(part)
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    key = lambda r: (r["property_id"], r["ts"].replace(tzinfo=None))
    got = spark.read.parquet(out)
    plain = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert plain(got.where("overall <> 'DUE'")) == plain(probes.decided(df))
    assert [key(r) for r in got.where("overall = 'DUE' and property_id = 9").collect()] == [(9, datetime.datetime(2026, 1, 8))]
