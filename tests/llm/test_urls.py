import duckdb

from textloom.llm import queries, url_filter

URLS = [
    None, "", "no scheme", "http://", "http://ORG", "http://org/", "https://a.example.org/es/1", "https://example.org/en/1", "https://example.org/en/2", "https://notexample.org/es/",
    "http://x.com/fr/", "http://x.com/de/?q", "http://x.com/de", "http://com/de/", "http://a.com?x=/de/", "http://a.com#/de/", "http://a.b://c/d", "https://www.spam-farm.example.com/en/1.html?utm_source=a&id=3#f",
    "http://spam-farm.example.com/en/1?id=3&ref=z", "http://spam-farm.example.com/en/1/", "https://m.other.net/en/7/", "https://other.net/en/7", "https://other.net/en/7", "ftp://ÄÖ.net/p", "http://x.com/" + "a" * 20_000,
]


def test_query_against_sql(spark, tmp_path):
    pages = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(URLS)], "page_id long, url string, host string, block int")
    pages.coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    mine = queries.op8_urls(spark, str(tmp_path)).toPandas()
    c = duckdb.connect()
    c.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    theirs = c.execute(url_filter.SQL).df()
    columns = sorted(mine.columns)
    clean = lambda f: sorted(map(repr, f[columns].astype(object).where(f[columns].notna(), None).itertuples(index=False, name=None)))
    assert clean(mine) == clean(theirs)
    rows = {r.page_id: (r.rule, r.verdict) for r in mine.itertuples()}
    assert rows[6] == ("example.org/es/", "block") and rows[7] == ("example.org/en/1", "block") and rows[8] == ("org/", "allow")
    assert rows[11] == ("com/de/", "block") and rows[12][1] == "allow"


def test_false_positives_are_removed(spark, monkeypatch):
    """With one block of one word every URL may pass the filter, and still only listed ones are blocked."""
    monkeypatch.setattr(url_filter, "BITS_PER_URL", 0)
    pages = spark.createDataFrame([(i, f"http://h{i % 50}.net/{i}") for i in range(300)] * 2, "page_id long, url string")
    listed = spark.createDataFrame([(f"h{i % 50}.net/{i}",) for i in range(0, 300, 3)] * 2 + [(None,)], "canon string")
    rows = url_filter.judge(pages, listed, rules=()).collect()
    assert len(rows) == 600 and all((r["verdict"] == "block") == (r["page_id"] % 3 == 0) for r in rows)


def test_large_filters_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BROADCAST_BLOCKS", 0)
    pages = spark.createDataFrame([(1, "http://a.net/1"), (2, "http://a.net/2")], "page_id long, url string")
    rows = url_filter.judge(pages, spark.createDataFrame([("a.net/1",)], "canon string")).collect()
    assert {r["page_id"]: r["verdict"] for r in rows} == {1: "block", 2: "allow"}
    assert url_filter.judge(pages.limit(0), spark.createDataFrame([], "canon string")).count() == 0
