"""Queries that take whole tables, on tables where a cut would show."""

import re

import duckdb

import __spark_entry__ as entry

SUFFIXES = dict(
    street="st", avenue="ave", av="ave", boulevard="blvd", road="rd", drive="dr", lane="ln", court="ct", place="pl", terrace="ter", parkway="pkwy", highway="hwy", circle="cir", square="sq",
    north="n", south="s", east="e", west="w", northeast="ne", northwest="nw", southeast="se", southwest="sw", apartment="apt", suite="ste", floor="fl",
)


def test_addresses_of_whole_texts_in_all_languages(spark, tmp_path):
    far = "word, " * 40 + "12 NORTH Main Street, 3rd Floor"
    texts = [(i, f"{i} {w.upper()}. {w}_x {w}", "en") for i, w in enumerate(SUFFIXES)]
    texts += [(100, far, "en"), (101, far, "de"), (102, far, None), (103, None, "fr"), (104, "", "fr"), (105, " ,;\n", "es"), (106, "9 Avenue d'Orléans\t— Suite 4", "fr")]
    spark.createDataFrame(texts, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    want = {i: None if t is None else " ".join(SUFFIXES.get(w, w) for w in re.sub(r"[^\w\s]", " ", t.lower()).split()) for i, t, _ in texts}
    got = entry.queries()["q_f01_address_whole"](spark, str(tmp_path)).collect()
    assert len(got) == len(want) and {r["doc_id"]: r["address"] for r in got} == want
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert dict(con.execute(entry.oracle_sql()["q_f01_address_whole"]).fetchall()) == want


def test_sort_gives_all_rows_in_order_with_nulls_last(spark):
    d = "/root/testdata/sf0.01"
    got = [tuple(r) for r in entry.queries()["q_o01_sort_all"](spark, d).collect()]
    assert len(got) == spark.read.parquet(f"{d}/customer.parquet").count() > 500
    assert got == sorted(got, key=lambda r: (r[1] is None, -(r[1] or 0), r[0])) and got[-1][1] is None
