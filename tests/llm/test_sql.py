"""Queries of this subpackage against their SQL on DuckDB, over the given tables and over tables with odd rows."""

import random

import duckdb
import pytest

from leasegrid.llm.queries import QUERIES, SQL

D = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "conversations")


def odd_tables(spark, root):
    rng = random.Random(11)
    line = "a line of more than twenty letters"
    words = [rng.choice("the of and to in is was for on as".split()) + str(rng.randrange(40)) for _ in range(400)]
    docs = [(i, " ".join(words[i * 7 : i * 7 + 60]) + rng.choice(["", f"\n{line}", f"\n {line.upper()} \t", "\n\n"])) for i in range(40)]
    docs += [(100 + i, " ".join(words[:50] + words[i : i + 4])) for i in range(12)]
    docs += [(200, None), (201, ""), (202, " \n\t"), (203, "two words"), (204, "two words"), (205, "x " * 20_000), (206, "é" * 30 + "\n" + line)]
    vecs = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(60)]
    vecs += [(100 + i, [v + rng.gauss(0, 0.1) for v in vecs[i % 5][1]]) for i in range(30)]
    vecs += [(200, None), (201, []), (202, [0.0] * 8), (203, [1.0] * 7 + [None]), (204, [float("nan")] * 8), (205, [float("inf")] + [1.0] * 7)]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "no", "ok!", "", " \t", "Why?\n", "ü.", None, "same text.", "a b c"]
    talks = [(c, t, rng.choice(roles), rng.choice(texts)) for c in range(-9, 90) for t in range(rng.randrange(10))]
    talks += [(500, None, "user", "n."), (500, None, "user", "n."), (500, 7, "user", "z?"), (None, 1, "user", "q?"), (None, 2, "assistant", None), (10**14, 1, "user", "far " * 5000)]
    spark.createDataFrame([(*r, "en", "s", 1) for r in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(vecs, "vec_id long, embedding array<double>").write.parquet(f"{root}/embeddings.parquet")
    spark.createDataFrame(talks, "conv_id long, turn long, role string, text string").write.parquet(f"{root}/conversations.parquet")


@pytest.fixture(scope="module")
def places(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("odd"))
    odd_tables(spark, root)
    return {"given": (D, "{}.parquet"), "odd": (root, "{}.parquet/*.parquet")}


def plain(v):
    return float(f"{v + 0.0:.9g}") if isinstance(v, float) else v


@pytest.mark.parametrize("where", ["given", "odd"])
@pytest.mark.parametrize("name", [n for n in SQL if n != "op7_tool_calls"])
def test_query_equals_sql(spark, places, name, where):
    root, files = places[where]
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"create view {t} as select * from '{root}/{files.format(t)}'")
    df = QUERIES[name](spark, root)
    cols = sorted(df.columns)
    got = duck.execute(SQL[name])
    have = [x[0] for x in got.description]
    assert sorted(have) == cols
    want = sorted((tuple(plain(row[have.index(c)]) for c in cols) for row in got.fetchall()), key=repr)
    assert sorted((tuple(plain(row[c]) for c in cols) for row in df.collect()), key=repr) == want
