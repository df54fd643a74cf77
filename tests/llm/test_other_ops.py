"""Embedding near-dedup, permutation index, sharding, tool calls and components against brute force."""

import itertools
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leasegrid.llm import embedding_dedup, permutation_ann, sharding, tool_calls
from leasegrid.llm import queries as llm_queries
from leasegrid.llm.shared import connected, shared_dir

D = "/root/testdata/sf0.01"


def closure(nodes, links):
    low = {n: n for n in nodes}
    while True:
        before = dict(low)
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
        if low == before:
            return low


@pytest.fixture(scope="module")
def odd(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(5, 8))
    rows = [(i, (base[i % 5] + rng.normal(size=8) * 0.25).tolist()) for i in range(60)]
    rows += [(100 + i, base[0].tolist()) for i in range(30)]
    rows += [(200, None), (201, []), (202, [0.0] * 8), (203, [1.0] * 7 + [None]), (204, [1.0] * 7 + [float("nan")]), (205, [float("inf")] + [1.0] * 7), (206, [1.0] * 3), (None, base[0].tolist()), (207, (base[1] * 1e-160).tolist())]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1.0, "x") for i, v in rows], "vec_id long, embedding array<double>, score double, component_id string").repartition(3)


def good(rows, length=8):
    return {i: np.array(v) for i, v in rows if i is not None and v and len(v) == length and None not in v and np.isfinite(v).all() and np.any(v)}


def near_by_force(rows):
    """(id, n_links, component, kept) of each row; each row is a vector of its own."""
    ok = [k for k, r in enumerate(rows) if r[0] is not None and r[1] and good([r], len(r[1]))]
    unit = {k: np.array(rows[k][1]) / np.abs(rows[k][1]).max() for k in ok}
    unit = {k: v / np.linalg.norm(v) for k, v in unit.items()}
    links = [(a, b) for a, b in itertools.combinations(ok, 2) if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9]
    part = closure(range(len(rows)), links)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[part[k]] = min(i, low.get(part[k], i))
    n = [sum(k in x for x in links) for k in range(len(rows))]
    return sorted(((i, n[k], low.get(part[k]) if i is not None else None, i is not None and i == low[part[k]]) for k, (i, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("cell", [4096, 16])
def test_near_duplicates_equal_brute_force(spark, odd, cell, monkeypatch):
    if cell == 16:
        monkeypatch.setattr(embedding_dedup, "HOMES", 7)
        monkeypatch.setattr(embedding_dedup, "MEMBERS", 11)
    got = embedding_dedup.near_duplicates(frame(spark, odd), cell_rows=cell).collect()
    assert sorted(map(tuple, got), key=repr) == near_by_force(odd)
    assert embedding_dedup.near_duplicates(frame(spark, odd).limit(0), cell_rows=cell).count() == 0


def test_near_duplicates_of_several_lengths_and_repeated_ids(spark):
    rng = np.random.default_rng(12)
    rows = [(i, rng.normal(size=2 + i % 3).round(1).tolist()) for i in range(90)]
    rows += [(200, [1.0, 2.0, 3.0]), (201, [1.0, 2.0, 3.0]), (202, [2.0, 4.0, 6.0]), (203, [1.0, 2.0, 3.0, 0.0])]
    # One id with two vectors, and a row twice.
    rows += [(300, [5.0, 0.0, 0.0, 0.0]), (300, [0.0, 5.0, 0.0, 0.0]), (301, [5.0, 0.1, 0.0, 0.0]), (301, [5.0, 0.1, 0.0, 0.0])]
    for cell in (4096, 8):
        got = embedding_dedup.near_duplicates(frame(spark, rows), cell_rows=cell).collect()
        assert sorted(map(tuple, got), key=repr) == near_by_force(rows)


def test_permutation_index_recall_and_scores(spark):
    e = spark.read.parquet(f"{D}/embeddings.parquet")
    x = {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in e.collect()}
    got = permutation_ann.search(e, F.col("vec_id") % 20 == 0).collect()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append(r)
        assert r["score"] == pytest.approx(float(x[r["query_id"]] @ x[r["vec_id"]]), abs=1e-12)
    hits = total = 0
    for q, rows in found.items():
        best = sorted((i for i in x if i != q), key=lambda i: (-(x[i] @ x[q]), i))[:20]
        hits, total = hits + len({r["vec_id"] for r in rows} & set(best)), total + len(best)
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, 21)) and rows == sorted(rows, key=lambda r: (-r["score"], r["vec_id"]))
    assert len(found) == 25 and hits / total >= 0.9


def neighbours(rows, queries, top):
    """{query: [(id, score)]}: exact, best vector of each id, vectors of the query's length only."""
    x = [(i, np.array(v)) for i, v in rows if i is not None and v and good([(i, v)], len(v))]
    out = {}
    for q, v in x:
        if q in queries:
            score = {}
            for i, w in x:
                if i != q and len(w) == len(v):
                    score[i] = max(score.get(i, -np.inf), float((w * v).sum()))
            out[q] = sorted(score.items(), key=lambda r: (-r[1], r[0]))[:top]
    return out


def recall(got, want):
    """Also: ranks run from 1, rows are in order, and every query has as many rows as there are."""
    found = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        found.setdefault(r["query_id"], []).append(r)
    assert found.keys() == {q for q, w in want.items() if w}
    for q, rows in found.items():
        assert [r["rank"] for r in rows] == list(range(1, len(want[q]) + 1)) and len({r["vec_id"] for r in rows}) == len(rows)
        assert rows == sorted(rows, key=lambda r: (-r["score"], r["vec_id"]))
    return sum(len({r["vec_id"] for r in rows} & {i for i, _ in want[q]}) for q, rows in found.items()) / sum(len(w) for w in want.values())


def test_permutation_index_on_few_rows_and_ties(spark, odd):
    by = F.col("vec_id") % 20 == 0
    want = neighbours(odd, {i for i, _ in odd if i is not None and i % 20 == 0}, 5)
    # With the registered parameters; and with all that matters met, where results are exact.
    assert recall(permutation_ann.search(frame(spark, odd), by, top=5).collect(), want) >= 0.9
    got = permutation_ann.search(frame(spark, odd), by, top=5, aim=1.0, sample=1000).collect()
    assert {q: [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in want} == {q: [i for i, _ in w] for q, w in want.items()}
    assert permutation_ann.search(frame(spark, odd).limit(0), by).count() == 0


@pytest.mark.parametrize("blocks", [None, (10, 7)])
def test_permutation_index_finds_all_there_is_in_small_clusters_and_every_length(spark, blocks, monkeypatch):
    if blocks:
        monkeypatch.setattr(permutation_ann, "BLOCK", blocks[0])
        monkeypatch.setattr(permutation_ann, "QUERIES", blocks[1])
    rng = np.random.default_rng(2)
    base = rng.normal(size=(5, 16)) * 10
    rows = [(i, (base[i % 5] + rng.normal(size=16) * 0.01).tolist()) for i in range(75)]
    rows += [(100 + i, rng.normal(size=3).tolist()) for i in range(9)] + [(0, [1.0, 0.0, 2.0]), (400, [1.0] * 5)]
    ids = {i for i, _ in rows if i % 4 == 0}
    want = neighbours([r for r in rows if len(r[1]) == 16], ids, 20)
    for q, w in neighbours([r for r in rows if len(r[1]) < 16], ids, 20).items():
        want[q] = sorted(want.get(q, []) + w, key=lambda r: (-r[1], r[0]))[:20]
    got = permutation_ann.search(frame(spark, rows), F.col("vec_id") % 4 == 0).collect()
    assert recall(got, want) >= 0.95 and 400 not in {r["query_id"] for r in got}


def test_permutation_index_recall_of_inner_products_of_unlike_lengths(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=24) * np.exp(rng.normal() * 0.5)).tolist()) for i in range(3000)]
    want = neighbours(rows, {i for i in range(0, 3000, 20)}, 20)
    assert recall(permutation_ann.search(frame(spark, rows), F.col("vec_id") % 20 == 0).collect(), want) >= 0.9


def test_permutation_index_counts_a_repeated_id_once(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=8)
    rows = [(i, (base + rng.normal(size=8) * 0.4).tolist()) for i in range(1, 61)] + [(0, base.tolist())]
    # 70 is repeated as it is, 71 with a little of another vector in each row; both are closer than all others.
    rows += [(70, (base * 2).tolist())] * 30 + [(71, (base * 2 - i * 1e-3).tolist()) for i in range(30)]
    want = neighbours(rows, {0}, 20)
    for aim, least in ((1.0, 1.0), (0.3, 0.3)):
        assert recall(permutation_ann.search(frame(spark, rows), F.col("vec_id") == 0, aim=aim).collect(), want) >= least


def test_components_equal_closure(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(400 + i, 401 + i) for i in range(60)] + [(500, 600 + i) for i in range(50)] + [(7, 7)]
    low = closure({x for e in edges for x in e}, edges)
    got = connected(spark.createDataFrame([*edges, (None, 3)], "a long, b long")).collect()
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert sorted((r[0], r[1]) for r in got) == sorted((x, low[x]) for x in linked)


def test_an_index_that_misses_its_aim_gives_way_to_the_whole_search(spark, monkeypatch, caplog):
    rng = np.random.default_rng(21)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(600)]
    monkeypatch.setattr(permutation_ann, "KEPT", 1)
    with caplog.at_level("INFO"):
        got = permutation_ann.search(frame(spark, rows), F.col("vec_id") % 20 == 0, top=20).collect()
    assert recall(got, neighbours(rows, set(range(0, 600, 20)), 20)) == 1.0 and "of the sample's neighbours" in caplog.text


def test_shards_hold_every_row_once_and_versions_are_atomic(spark):
    rows = [(i if i % 9 else None, "text %d" % i * (i % 50), i % 8, "r", i, None) for i in range(400)] + [(1, "again", 0, "r", 1, "all")] * 5
    rows += [(500, None, 1, None, None, None), (501, "", 1, None, None, None), (502, "long " * 200_000, 1, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tier int, run string, shard long, Arrival string").repartition(4)
    store = sharding.ShardStore(spark, f"{shared_dir(spark)}/test-shards-{random.random()}", target_bytes=4000, base_bytes=500, fan=3)
    assert store.read() is None and store.runs() == []
    store.append(docs, F.pmod("doc_id", F.lit(8)))
    before = store.versions()
    assert len(before) == 1 and len(store.runs()) == 9
    plain = lambda df: sorted(map(tuple, df.select("row.*").collect()), key=repr)
    want = sorted(rows, key=repr)
    assert plain(store.read()) == want
    assert store.compact() > 0
    tiers = [r.tier for r in store.runs()]
    assert all(tiers.count(t) < 3 for t in tiers)
    assert plain(store.read()) == plain(store.read(before[-1])) == want
    assert {(r["run"], r["tier"]) for r in store.read().select("run", "tier").distinct().collect()} == {(r.number, r.tier) for r in store.runs()}
    with pytest.raises(Exception, match="(?i)exist"):
        store.commit(store.runs(), store.versions()[-1])
    assert store.vacuum() > 0 and plain(store.read()) == want
    store.append(docs.limit(0))
    assert plain(store.read()) == want
    # The text "null" and a null are two arrivals.
    have = len(store.runs())
    store.append(spark.createDataFrame([("null",), (None,), ("null",)], "k string"), F.col("k"))
    assert len(store.runs()) == have + 2


def test_shards_of_unlike_columns_keep_them_all(spark):
    store = sharding.ShardStore(spark, f"{shared_dir(spark)}/test-shards-{random.random()}", fan=2)
    store.append(spark.createDataFrame([(1, "a")], "id long, text string"))
    store.append(spark.createDataFrame([("b", 2.5, 2, ["x"])], "Text string, score double, id long, tags array<string>"))
    with pytest.raises(ValueError, match="SCORE is string, but double"):
        store.append(spark.createDataFrame([("no",)], "SCORE string"))
    assert len(store.versions()) == 2
    want = [(1, "a", None, None), (2, "b", 2.5, ["x"])]
    rows = lambda: sorted(map(tuple, store.read().select("row.id", "row.text", "row.score", "row.tags").collect()))
    assert rows() == want and store.compact() == 1 and rows() == want and store.vacuum() == 2 and rows() == want
    # A third arrival of an old column meets the merged run.
    store.append(spark.createDataFrame([(3,)], "id int").select(F.col("id").cast("long")))
    assert store.compact() == 1 and rows() == [*want, (3, None, None, None)] and [r.rows for r in store.runs()] == [3]


def test_tiers_follow_size_and_lost_files_show(spark):
    store = sharding.ShardStore(spark, f"{shared_dir(spark)}/test-shards-{random.random()}", base_bytes=4000, fan=4)
    store.append(spark.range(16).select(F.col("id"), F.lit("x").alias("t")), F.col("id"))
    assert store.compact() == 5 and [(r.tier, r.rows) for r in store.runs()] == [(0, 16)]
    store.append(spark.createDataFrame([(1, "".join(random.Random(1).choices("abcdefghij", k=200_000)))], "id long, t string"))
    assert sorted(r.tier for r in store.runs()) == [0, 2] and store.compact() == 0
    run = store.runs()[-1]
    assert store.lost() == [] and sum(n for _, n in run.files) == run.bytes
    jvm, fs = store._fs()
    fs.delete(jvm.org.apache.hadoop.fs.Path(f"{run.path}/{run.files[0][0]}"), False)
    assert store.lost() == [f"{run.path}/{run.files[0][0]}"]


def test_sharding_query_on_documents_with_clashing_columns(spark, tmp_path):
    rows = [(i, f"text {i}", "x", 1, 2, "a") for i in range(50)]
    spark.createDataFrame(rows, "doc_id long, text string, run string, tier int, shard int, arrival string").write.parquet(f"{tmp_path}/documents.parquet")
    got = llm_queries.op3_sharding(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["n_bytes"]) for r in got) == sorted((i, len(t)) for i, t, *_ in rows)


SCHEMAS = {"sum": {"a": ("integer", True), "b": ("number", True), "note": ("string", False)}}


def test_tool_calls_link_order_and_validation(spark):
    calls = [(1, "r", None, "sum", '{"b": 2.5, "a": 1}')] + [(1, f"c{i}", f"c{i - 1}" if i else "r", "sum", '{"a": 1, "b": 2}') for i in range(20)]
    calls += [(2, "x", "y", "sum", "{}"), (2, "y", "x", "sum", '{"a": "1", "b": 2, "z": 0}'), (2, "tail", "x", "none", None), (3, "lost", "nowhere", "sum", "[1]"), (3, None, None, None, "oops")]
    results = [(1, "r", 2, "second"), (1, "r", 1, 'first "quoted"\n'), (9, "ghost", 1, None), (9, None, 1, "no id")]
    frames = spark.createDataFrame(calls, "conv_id long, call_id string, parent_id string, tool string, arguments string"), spark.createDataFrame(results, "conv_id long, call_id string, seq long, content string")
    got = {(r["status"], r["call_id"]): r for r in tool_calls.link(*frames, SCHEMAS).collect()}
    assert [got["open", f"c{i}"]["depth"] for i in range(20)] == list(range(1, 21))
    r = got["linked", "r"]
    assert (r["depth"], r["n_results"], r["errors"]) == (0, 2, [])
    assert r["json"] == json.dumps({"arguments": {"a": 1, "b": 2.5}, "id": "r", "parent": None, "result": 'first "quoted"\n', "tool": "sum"}, separators=(",", ":"))
    assert got["open", "x"]["depth"] is None and got["open", "x"]["errors"] == ["cyclic", "a missing", "b missing"]
    assert got["open", "y"]["errors"] == ["cyclic", "a is not integer", "unexpected z"]
    assert got["open", "tail"]["errors"] == ["cyclic", "not an object"]
    assert got["open", "lost"]["errors"] == ["parent missing", "not an object"] and got["open", "lost"]["depth"] == 0
    assert got["orphan", "ghost"]["errors"] == ["call missing"] and ("orphan", None) in got
    assert tool_calls.link(frames[0].limit(0), frames[1].limit(0), SCHEMAS).count() == 0


def depths_by_force(calls):
    """Longest path of parents that exist; None on or behind a cycle."""
    up = {}
    for i, parents in calls:
        if i is not None:
            up.setdefault(i, set()).update(p for p in parents or [] if p is not None)
    up = {i: {p for p in ps if p in up} for i, ps in up.items()}
    depth = {}
    while True:
        now = {i: 1 + max((depth[p] for p in ps), default=-1) for i, ps in up.items() if i not in depth and all(p in depth for p in ps)}
        if not now:
            return {i: depth.get(i) for i in up}
        depth |= now


def test_depths_of_calls_with_several_parents(spark):
    rng = random.Random(5)
    calls = [(f"{g}-{i}", [f"{g}-{rng.randrange(i)}" for _ in range(rng.choice([1, 1, 1, 1, 2, 3]))] if i else None) for g in range(4) for i in range(40)]
    calls += [("a", ["b"]), ("b", ["a"]), ("c", ["b", "0-0"]), ("d", ["c"]), ("e", ["nowhere", "0-3", None, "0-3"]), ("self", ["self"]), (None, ["0-0"]), ("0-5", ["0-39"]), ("twice", []), ("twice", ["1-7"])]
    calls += [(f"hub{i}", ["2-39"]) for i in range(50)]
    frame_ = spark.createDataFrame([(1, i, p, "sum", "{}", 9) for i, p in calls], "conv_id long, call_id string, parent_ids array<string>, tool string, arguments string, depth long")
    none = spark.createDataFrame([], "conv_id long, call_id string, seq long, content string")
    got = tool_calls.link(frame_, none, SCHEMAS).collect()
    want = depths_by_force(calls)
    assert len(got) == len(calls) and all(r["depth"] == want[r["call_id"]] for r in got if r["call_id"] is not None)
    assert sum(d is None for d in want.values()) > 4
    assert {r["call_id"] for r in got if "parent missing" in r["errors"]} == {"e"}
    assert json.loads(next(r["json"] for r in got if r["call_id"] == "c"))["parents"] == ["b", "0-0"]


def test_tool_calls_of_repeated_rows_and_odd_texts(spark):
    long = "word " * 100_000
    calls = spark.createDataFrame([(1, "r", None, "sum", "", "x")] * 3 + [(1, "q", "r", "sum", json.dumps({"a": 1, "b": 2, "note": long}), "x")], "conv_id long, call_id string, parent_id string, tool string, arguments string, status string")
    results = spark.createDataFrame([(1, "r", 1, "", 7)] * 2 + [(1, "q", 1, long, 7)], "conv_id long, call_id string, seq long, content string, n_results int")
    got = tool_calls.link(calls, results, SCHEMAS).collect()
    assert sorted((r["call_id"], r["status"], r["n_results"], r["depth"]) for r in got) == [("q", "linked", 1, 1), *[("r", "linked", 2, 0)] * 3]
    assert json.loads(next(r["json"] for r in got if r["call_id"] == "q"))["result"] == long
    assert {json.loads(r["json"])["result"] for r in got if r["call_id"] == "r"} == {""}


def test_tool_calls_keep_every_result(spark):
    """Results without an id are an orphan each, and further results of an id are rows of their own."""
    calls = [(1, "r", None, "sum", '{"b": 2.5, "a": 1}')]
    results = [(1, None, 1, "no turn"), (2, None, 1, "no turn"), (None, None, 2, "no conversation"), (None, None, 2, "no conversation")]
    results += [(1, "r", 2, "second"), (1, "r", 1, "first"), (1, "r", 1, "first"), (1, "r", 2, "second"), (1, "r", 3, None), (8, "ghost", 5, "later"), (9, "ghost", 4, "sooner")]
    got = tool_calls.link(spark.createDataFrame(calls, "conv_id long, call_id string, parent_id string, tool string, arguments string"), spark.createDataFrame(results, "conv_id long, call_id string, seq long, content string"), SCHEMAS).collect()
    rows = sorted([(r["status"], r["conv_id"], r["call_id"], r["n_results"], json.loads(r["json"])["result"]) for r in got], key=repr)
    want = [("orphan", 1, None, 1, "no turn"), ("orphan", 2, None, 1, "no turn"), *[("orphan", None, None, 0, "no conversation")] * 2, ("linked", 1, "r", 5, "first")]
    want += [("further", 1, "r", 2, "second"), ("further", 1, "r", 1, None), ("orphan", 9, "ghost", 2, "sooner"), ("further", 8, "ghost", 1, "later")]
    assert rows == sorted(want, key=repr)


def test_tool_calls_equal_sql_where_keys_of_results_are_null(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), *[(None, t, "assistant", f"lost {t}") for t in (1, 1, 3)], (2, None, "assistant", "when"), (3, None, "assistant", None)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.execute(llm_queries.SQL["op7_tool_calls"])
    names = [c[0] for c in want.description]
    assert sorted(map(tuple, llm_queries.op7_tool_calls(spark, str(tmp_path)).select(*names).collect()), key=repr) == sorted(want.fetchall(), key=repr)
