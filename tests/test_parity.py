"""Every registered query with SQL gives what DuckDB gives on the same tables."""

import datetime
import math

import duckdb
import pytest

import __spark_entry__ as entry
from leasegrid.plans import registry

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{D}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v + 0.0:.9g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return float(v) if type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, D)
    cols = sorted(df.columns)
    r = duck.execute(entry.oracle_sql()[name])
    have = [x[0] for x in r.description]
    assert sorted(have) == cols
    at = [have.index(c) for c in cols]
    want = sorted((tuple(plain(row[i]) for i in at) for row in r.fetchall()), key=repr)
    assert sorted((tuple(plain(row[c]) for c in cols) for row in df.collect()), key=repr) == want


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["q_x20_kept_text", "q_x32_metadata"])
def test_titles_that_end_inside_a_reference_equal_sql(spark, tmp_path, name):
    ends = ["&quot", "&quo", "&qu", "&amp", "&am", "&a", "&", "&quot;", "&copy", "&lt", "&#3", "&amp;quot"]
    pages = [(i, f"https://x/{i}", f"<html><head><title>token = {e}</title></head><body><h1>token = {e}</h1><p>a &amp; b {e}</p><footer>&copy; 2024 &middot; us</footer></body></html>") for i, e in enumerate(ends)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    c = duckdb.connect()
    c.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    df = entry.queries()[name](spark, str(tmp_path))
    r = c.execute(entry.oracle_sql()[name])
    have = [x[0] for x in r.description]
    want = sorted((dict(zip(have, map(plain, row), strict=True)) for row in r.fetchall()), key=repr)
    assert sorted(({h: plain(row[h]) for h in have} for row in df.collect()), key=repr) == want
