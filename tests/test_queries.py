"""Every query with SQL gives DuckDB's rows over the smallest tables."""

import glob
import os

import pytest

import __spark_entry__ as entry
from quarrymark.plans import QUERIES, SQL
from tools.oracle import rows

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    import duckdb

    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_rows_match_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    want = con.sql(SQL[name])
    assert got == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_queries_without_sql_run(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(SQL) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["merge_pools_priority", "cached_range_fetch"])
def test_pages_with_one_url_stay_apart(spark, tmp_path, name):
    import duckdb

    pages = [(k, f"https://a.example.{('org', 'com', 'net')[k // 2 % 3]}/{k // 4}", f"<p>{k}</p>") for k in range(60)]
    pages += [(60, "https://org/x", "<p>a TLD alone</p>"), (61, "https://a.org:80/x", "<p>a port</p>")]
    assert len({url for _, url, _ in pages}) < len(pages)
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    df, want = QUERIES[name](spark, str(tmp_path)), c.sql(SQL[name])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(want.columns, want.fetchall())
