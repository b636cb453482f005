"""Every query with SQL against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from gleanery.plans import registry


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def norm(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_against_sql(spark, sf, duck, name):
    got = registry.QUERIES[name](spark, sf)
    cols = sorted(got.columns)
    want = duck.sql(registry.ORACLES[name])
    assert sorted(want.columns) == cols
    rows = sorted(str([norm(r[c]) for c in cols]) for r in got.collect())
    assert rows == sorted(str([norm(v) for v in r]) for r in duck.sql(f"SELECT {','.join(cols)} FROM ({registry.ORACLES[name]})").fetchall())


def test_odd_titles_against_sql(spark, tmp_path):
    """Titles whose references are cut off, rare or nested, odd blanks, and pages without a plain title element."""
    name = "extract_title__X07"
    titles = ["des&amp", "a &quot;b&quot; &#39;c&#x27; &nbsp;&eacute;", "&amp;lt; &amp;amp; &lt;b&gt; &ltb &AMP;", " \n a\t\r\n\fb \v c ", "\xa0\u3000a\xa0\xa0b\u2003", "\x85a\u2028", "", "  "]
    pages = [f"<html><head><title>{t}</title></head><body><svg><title>drawn</title></svg></body>" for t in titles]
    pages += ["<TITLE>a</TITLE>", '<title lang="en">a</title>', "<title>a<b>c</b></title><title>d</title>", "<title>never closed", "<!-- <title>a</title> --><title>b</title>", "no title", "", None]
    spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    got = registry.QUERIES[name](spark, str(tmp_path))
    assert dict(map(tuple, got.select("page_id", "title").collect())) == dict(con.sql(registry.ORACLES[name]).fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(spark, sf, name):
    assert registry.QUERIES[name](spark, sf).limit(5).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
