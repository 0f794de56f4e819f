"""Every registered query of the library against its SQL on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__
from feedloom.plans.catalog import ORACLE, QUERIES

SF = os.environ.get("FEEDLOOM_TEST_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
        return None
    return f"{v:.9g}" if isinstance(v, float) else str(v)


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(tuple(str(plain(v)) for v in r) for r in df.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert len(set(got.columns)) == len(got.columns)
    if name in ORACLE:
        want = duck.sql(ORACLE[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_semantic_dedup_reads_whole_texts(spark, tmp_path):
    words = lambda c, n: " ".join(f"{c}{i}" for i in range(n))
    texts = [words("head", 60) + " " + words("tail", 1500), words("head", 60) + " " + words("rest", 1500), words("lead", 60) + " " + words("tail", 1500)]
    docs = [(i, t, "en", f"s{i}", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.ord: (r.action, r.similar_to) for r in QUERIES["semantic_dedup"](spark, str(tmp_path)).collect()}
    assert got == {0: ("keep", None), 1: ("keep", None), 2: ("drop", "https://s0.example.org/a/0")}


def test_html_metadata_decodes_as_its_sql(spark, tmp_path):
    titles = ["of.&&&amp", "a &amp;amp b &amp;lt; c", "x &copy; &eacute &lt;b&gt; &quot;q&quot; &#39;r&#39; &#x41;", "  a &nbsp; b\u00a0 ", ""]
    pages = [(i, f"https://a.test/{i}", f'<html><title>{t}</title><meta name="author" content="{t}"></html>') for i, t in enumerate(titles)] + [(9, None, None)]
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    got = QUERIES["html_metadata"](spark, str(tmp_path)).toPandas()
    assert rows(got) == rows(con.sql(ORACLE["html_metadata"]).df())
    assert dict(zip(got.page_id, got.title))[0] == "of.&&&amp"


def test_pushed_items_join_picks_as_its_sql(spark, tmp_path):
    base = "https://a.test/p"
    urls = [base, f"{base}/", f"{base}//", base, "https://a.test/q#top", "https://a.test/q#top", "https://a.test/r.", f"{base}/", "https://b.test/?x=1", "https://b.test", "https://b.test/"]
    pages = [(i * 50 + (i % 2) + 100 * (i == 3), u, "") for i, u in enumerate(urls)]
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    got = QUERIES["pushed_items_join"](spark, str(tmp_path)).toPandas()
    assert rows(got) == rows(con.sql(ORACLE["pushed_items_join"]).df())


def test_similar_pairs_reads_whole_texts(spark, tmp_path):
    """Texts that agree in their first lines and 200 characters alone are not linked; copies are one class."""
    words = lambda c, n: " ".join(f"{c}{i}" for i in range(n))
    texts = [words("head", 60) + "\n" + words("tail", 1500), words("head", 60) + "\n" + words("rest", 1500), words("lead", 60) + "\n" + words("tail", 1500), None, "", words("head", 60) + "\n" + words("tail", 1500), "ab c"]
    docs = [(i, t, "en", f"s{i}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = QUERIES["similar_pairs"](spark, str(tmp_path)).toPandas()
    assert rows(got) == rows(con.sql(ORACLE["similar_pairs"]).df())
    by = {r.doc_id: (r.class_id, r.n_links) for r in got.itertuples()}
    assert by == {0: (0, 2), 1: (1, 0), 2: (2, 2), 3: (3, 0), 4: (4, 0), 5: (0, 2), 6: (6, 0)}
