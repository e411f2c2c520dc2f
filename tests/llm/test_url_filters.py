from urllib.parse import urlsplit

from pyspark.sql import functions as F

from daybeat.llm import url_filters as u
from daybeat.llm.catalog import QUERIES

SMALL = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"


def brute_rule(host, path):
    fits = [r for r, _ in u.RULES for own, start in [(r[:r.index("/")], r[r.index("/"):])]
            if (host == own or host.endswith("." + own)) and path.startswith(start)]
    return max(fits, key=len, default=None)


def judged(spark, urls, **options):
    df = spark.createDataFrame([(k, x, "") for k, x in enumerate(urls)], PAGES)
    return {r.page_id: r for r in u.judge(df, **options).collect()}


def test_query_on_all_pages(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    found = QUERIES["op6_url_filters"](spark, SMALL).collect()
    assert len(found) == len(urls)
    for r in found:
        parts = urlsplit(urls[r.page_id])
        assert (r.host, r.path) == (parts.netloc.lower(), parts.path)
        assert r.rule == brute_rule(r.host, r.path)
        assert r.rule is None or r.verdict == dict(u.RULES)[r.rule]
        assert r.verdict in ("allow", "block")


def test_awkward_urls(spark):
    urls = [None, "", "no scheme/com/de/", "http://", "HTTP://Sub.Example.ORG/es/x", "http://example.org/es/", "http://org",
            "http://badexample.org/es/", "http://a.com?x=/fr/", "http://a.com#/fr/", "x://y://com/de/", "http://a.com/" + "s/" * 500,
            "http://ÄÖ.com/fr/é", "http://example.org/en/12", "http://example.org/en/12"]
    found = judged(spark, urls)
    where = {k: (r.host, r.path, r.rule) for k, r in found.items()}
    assert where[0] == where[1] == where[2] == ("", "", None) and where[3] == ("", "", None)
    assert where[4] == ("sub.example.org", "/es/x", "example.org/es/") and found[4].verdict == "block"
    assert where[6] == ("org", "", None) and where[7][2] == "org/"
    assert where[8] == ("a.com", "", None) and where[9] == ("a.com", "", None) and where[10][0] == "y:"
    assert where[12][0] == "ÄÖ.com" and where[13][2] == "example.org/en/1" == where[14][2]


def test_template_learns_from_labelled_pages(spark):
    rules = (("com/spam/a", "block"), ("com/news/a", "allow"))
    urls = [f"http://x.com/spam/a{k}" for k in range(60)] + [f"http://x.com/news/a{k}" for k in range(60)]
    urls += ["http://x.com/spam/b7", "http://x.com/news/b7", "http://x.com/other/b7", "http://y.com/spam/b7"]
    found = judged(spark, urls, rules=rules)
    # The last segment has many values, so it is one wildcard: other pages below learn from the labelled ones.
    assert found[120].rule is None and found[120].verdict == "block"
    assert [found[k].verdict for k in (121, 122, 123)] == ["allow"] * 3


def test_variable_segments_and_merging(spark):
    urls = [f"http://x.com/en/{w}" for w in "abcdefghijkl"] + [f"http://x.com/de/{k}" for k in range(9)]
    found = judged(spark, urls, rules=())
    assert {found[k].template for k in range(12)} == {"/de|en/*"} or {found[k].template for k in range(12)} == {"/de|en/<n>|a"}


def test_extra_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "http://x.com/", "")], PAGES).withColumn("host", F.lit("own")).withColumn("segments", F.lit(1))
    out = u.judge(df)
    assert out.columns == ["page_id", "url", "html", "segments", "host", "path", "rule", "template", "purity", "verdict"]
    assert out.first().segments == 1
    assert u.judge(df.limit(0)).count() == 0
