from datetime import date

from skyphrase.llm import url_lists
from skyphrase.llm.queries import op3_url_lists

from ..compare import duck, same

ENTRY = "pattern string, category string, action string, dated string"


def test_as_of(spark):
    entries = spark.createDataFrame(
        [
            ("bad.com", "x", "add", "2024-01-10"), ("bad.com", "x", "drop", "2024-02-01"), ("bad.com", "x", "add", "2024-03-01"), ("bad.com", "y", "add", "2024-02-15"),
            ("https://Good.com/Ads/", "z", "add", "2024-01-01"), (".sub.org", None, "ADD", "2024-01-01"), ("same.day", "x", "add", "2024-01-01"), ("same.day", "x", "drop", "2024-01-01"),
            (None, "x", "add", "2024-01-01"), ("nodate.com", "x", "add", None), ("bad.com", "x", "add", "2024-03-01"), ("noact.com", "x", None, "2024-01-01"),
        ],
        ENTRY,
    )
    cases = [
        ("http://bad.com/", "2024-01-09", 0, "", None), ("http://bad.com/", "2024-01-10", 1, "x", "bad.com"), ("http://www.BAD.com./p?q", "2024-01-31", 1, "x", "bad.com"),
        ("http://bad.com", "2024-02-01", 0, "", None), ("http://bad.com", "2024-02-20", 1, "y", "bad.com"), ("http://bad.com:80/a", "2024-03-01", 2, "x,y", "bad.com"),
        ("http://notbad.com", "2024-03-01", 0, "", None), ("https://u:p@good.com/ads/1.html", "2024-05-01", 1, "z", "good.com/ads"), ("https://good.com/adsx", "2024-05-01", 0, "", None),
        ("https://www.good.com/ads", "2024-05-01", 0, "", None), ("ftp://a.sub.org/x", "2024-01-01", 1, "", "sub.org"), ("http://same.day", "2024-06-01", 0, "", None),
        ("http://nodate.com", "2024-06-01", 0, "", None), (None, "2024-06-01", 0, "", None), ("http://bad.com", None, 0, "", None), ("not a url", "2024-06-01", 0, "", None), ("http://noact.com", "2024-06-01", 0, "", None),
    ]
    rows = [(k, u, date.fromisoformat(d) if d else None, "clash", "clash") for k, (u, d, *_) in enumerate(cases)]
    captures = spark.createDataFrame(rows + rows[1:2], "page_id long, url string, fetched date, host string, key string").selectExpr("*", "1 AS best", "2 AS _day", "3 AS _path", "4 AS _h")
    out = url_lists.filter_urls(captures, entries)
    got = sorted((r["page_id"], r["n_entries"], r["categories"], r["pattern"] or "", r["blocked"]) for r in out.collect())
    wanted = sorted((k, n, c, p or "", n > 0) for k, (_, _, n, c, p) in list(enumerate(cases)) + [(1, cases[1])])
    assert got == wanted and {"key", "best", "_day"} < set(out.columns) and {r["best"] for r in out.collect()} == {1}


def test_empty_tables(spark):
    none = spark.createDataFrame([], ENTRY)
    captures = spark.createDataFrame([(1, "http://a.b", date(2024, 1, 1))], "page_id long, url string, fetched date")
    assert url_lists.filter_urls(captures, none).first()["blocked"] is False
    assert url_lists.filter_urls(captures.where("false"), none).count() == 0


def test_query_against_sql(spark, sf_dir):
    from skyphrase.llm.oracle import oracle_sql

    same(op3_url_lists(spark, sf_dir), duck(sf_dir), oracle_sql()["op3_url_lists"])
