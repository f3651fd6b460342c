from conftest import canonical
from pyspark.sql import functions as F

from corpusmill.llm import url_filter as u

URLS = ["http://A.example.net/en/x?q#f", "https://example.net/de/x", "ftp://net", "x.net/", None, "", "http://example.com/de/", "http://sub.example.com/deep", "http://notexample.com/de/", "http://a.org/fr/1", "http://org/fr/", "http://a.orgs/fr/", "http://?q", "http://h#f", "a://b://c/d", "http://user@www.site.info/p/?utm_source=x&ref=1&k=2#z", "http://site.info/p?k=2", "HTTP://SITE.info/p/?k=2", "http://site.info/P?k=2"]


def test_rules_and_list(spark):
    pages = spark.createDataFrame([(i, x, "mine") for i, x in enumerate(URLS)], "page_id int, url string, verdict string")
    listed = spark.createDataFrame([("http://site.info/p/?k=2",), (None,), ("http://site.info/p/?k=2",), ("http://x.net/",)], "url string")
    got = {r["page_id"]: r for r in u.judge(pages, listed).collect()}
    assert len(got) == len(URLS)
    rules = {i: got[i]["rule"] for i in got}
    assert [rules[i] for i in range(15)] == ["example.net/en/", "net/", None, None, None, None, "example.com/de/", None, None, "org/fr/", "org/fr/", None, None, None, None]
    assert (got[0]["host"], got[0]["path"], got[0]["verdict"]) == ("a.example.net", "/en/x", "allow")
    assert (got[4]["host"], got[4]["path"], got[4]["verdict"]) == ("", "", "allow")
    assert (got[14]["host"], got[14]["path"]) == ("b:", "//c/d")
    assert [got[i]["is_listed"] for i in (15, 16, 17, 18)] == [False, True, True, False]


def test_filter_has_no_misses_and_the_join_no_false_hits(spark):
    pages = spark.range(4000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.info/"), F.col("id") % 1500).alias("url"))
    listed = spark.range(0, 1500, 3).select(F.concat(F.lit("http://h.info/"), "id").alias("url"))
    for bits in (1, 16):
        got = u.listed_urls(pages, listed, bits_per_url=bits)
        assert got.count() == 4000 and got.where(F.col("is_listed") != (F.col("page_id") % 1500 % 3 == 0)).count() == 0


def test_large_filters_are_joined(spark, monkeypatch):
    monkeypatch.setattr(u, "FILTER_BLOCKS", 0)
    test_filter_has_no_misses_and_the_join_no_false_hits(spark)


def test_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.info/x", "p", 5, True), (2, "http://b.info/", "q", 6, None)], "w0 int, url string, page string, filter_block int, is_listed boolean")
    got = u.judge(pages, spark.createDataFrame([("http://a.info/x",)], "url string"))
    assert got.columns == ["w0", "url", "page", "filter_block", "canonical_url", "is_listed", "host", "path", "rule", "verdict"]
    assert sorted((r["w0"], r["page"], r["filter_block"], r["verdict"]) for r in got.collect()) == [(1, "p", 5, "block"), (2, "q", 6, "allow")]


def test_empty(spark):
    none = spark.createDataFrame([], "page_id int, url string")
    assert u.judge(none, none.select("url")).count() == 0
    assert u.judge(spark.createDataFrame([(1, "http://a.b/")], "page_id int, url string"), none.select("url")).first()["verdict"] == "allow"


def test_sql(spark, duck, small):
    assert canonical(u.op9_url_filter(spark, small).toPandas()) == canonical(duck.execute(u.OP9_SQL).df())


def test_main_path_has_no_python(spark, small):
    plan = u.op9_url_filter(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


SPAM = ["https://m.ads-track.example.com/en/1", "http://www.m.ads-track.example.com/en/1/?utm_source=feed", "https://m.ads-track.example.com/fr/1", "https://m.ads-track.example.com/en/2?page=2&ref=x", "https://m.ads-track.example.com/en/2?page=3", "https://other.info/en/1", "https://x.example.com/en/1", "http://casino-win.info/en/", "http://WWW.casino-win.info/en", "http://casino-win.info/en/?a=1&&utm_x"]


def test_the_list_decides_not_the_host(spark, tmp_path):
    """Unlisted pages of listed hosts are allowed, and other spellings of a listed URL blocked, in the query and its SQL."""
    import duckdb

    spark.createDataFrame([(i, x, None) for i, x in enumerate(URLS + SPAM)], "page_id int, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    got = u.op9_url_filter(spark, str(tmp_path)).toPandas()
    assert canonical(got) == canonical(con.execute(u.OP9_SQL).df())
    verdict = dict(zip(got.page_id, got.verdict))
    assert [verdict[len(URLS) + i] for i in range(len(SPAM))] == ["block", "block", "allow", "block", "block", "allow", "allow", "block", "block", "block"]


def test_sql_on_more_pages(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("create view pages as select * from read_parquet('/root/testdata/sf0.1/pages.parquet')")
    assert canonical(u.op9_url_filter(spark, "/root/testdata/sf0.1").toPandas()) == canonical(con.execute(u.OP9_SQL).df())
