import itertools
import re

from pyspark.sql import functions as F

from farelight.llm import url_filter


def brute(url, rules):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest, re.S)[0]
        path = re.match("[^?#]*", rest[len(host) :], re.S)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [
        (len(h) + len(p), len(h), v, h + p) for v, h, p in rules
        if host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if fits:
        best = max(fits)
        return host, path, best[3], best[2]
    words = set(re.split("[.-]", host))
    return host, path, None, "block" if not host or words & set(url_filter.BLOCKED_WORDS) else "allow"


URLS = [
    None, "", "no scheme", "http://", "://x.org/", "http://EXAMPLE.ORG/es/1?x=/de/", "https://a.example.org/en/1", "https://a.example.org/en/2",
    "http://notexample.org/es/", "http://org/", "http://com/de/x", "http://x.com", "http://x.com?/de/", "http://x.com#/de/", "http://x.com/de",
    "http://x.com/fr/://y.org/", "http://www.cheap-pills.example.net/a", "http://cheapish.net/", "ftp://user@x.com:80/de/", "http://é.com/de/é",
    "http://a..com/de/", "http://x.com/de/\nline", "HTTP://X.COM/FR/", "http://x.net/" + "p/" * 20_000, "http://" + "a." * 300 + "com/fr/1",
]


def test_against_the_definition(spark):
    many = [("allow", "com", ""), ("block", "x.com", "/"), ("block", "com", "/"), ("allow", "net", "/p/p"), *url_filter.RULES]
    for rules in (url_filter.RULES, tuple(many)):
        pages = spark.createDataFrame(list(enumerate(URLS * 2)), "page_id int, url string").repartition(3)
        found = {r["page_id"]: tuple(r)[1:] for r in url_filter.judge(pages, url_filter.rules_table(spark, rules)).collect()}
        assert found == {i: brute(u, rules) for i, u in enumerate(URLS * 2)}


def test_the_same_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "hint_small", lambda df: df.hint("merge"))
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id int, url string")
    found = {r["page_id"]: tuple(r)[1:] for r in url_filter.judge(pages, url_filter.rules_table(spark)).collect()}
    assert found == {i: brute(u, url_filter.RULES) for i, u in enumerate(URLS)}


def test_equal_short_hashes_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "short", lambda host, path: F.lit("same"))
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id int, url string")
    found = {r["page_id"]: tuple(r)[1:] for r in url_filter.judge(pages, url_filter.rules_table(spark)).collect()}
    assert found == {i: brute(u, url_filter.RULES) for i, u in enumerate(URLS)}


def test_repeated_rows_null_ids_and_no_rows(spark):
    rows = [(1, "http://x.com/de/1", "a"), (1, "http://x.com/de/1", "a"), (None, "http://x.com/fr/1", None), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string").withColumns({c: F.lit(1) for c in ("path", "rule", "row", "short")})
    found = [tuple(r) for r in url_filter.judge(pages, url_filter.rules_table(spark)).collect()]
    assert sorted(found, key=str) == sorted([(i, *brute(u, url_filter.RULES)) for i, u, _ in rows], key=str)
    assert url_filter.judge(pages.limit(0), url_filter.rules_table(spark)).count() == 0
    assert {r["rule"] for r in url_filter.judge(pages, url_filter.rules_table(spark).limit(0)).collect()} == {None}


def test_no_python_runs_on_the_main_path(spark, sf_dir):
    plan = url_filter.op5_url_filter(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in itertools.chain(("Python", "Pandas", "Arrow"), ("Cartesian", "NestedLoop")))


def test_very_long_hosts(spark):
    """A host is looked at once per shape of the rules, not once per label."""
    rules = [("block", "com", "/"), ("allow", "b.com", "/x"), ("block", ".".join("c" * 50), ""), *url_filter.RULES]
    urls = ["http://" + "a." * 40_000 + "b.com/x", "http://" + "c." * 40_000 + "c", "http://" + "x" * 200_000 + ".org/", "http://" + "." * 30_000 + "/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    found = {r["page_id"]: tuple(r)[1:] for r in url_filter.judge(pages, url_filter.rules_table(spark, rules)).collect()}
    assert found == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_shapes_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MOST_SHAPES", 3)
    pages = spark.createDataFrame([(1, "http://x.com/")], "page_id int, url string")
    try:
        url_filter.judge(pages, url_filter.rules_table(spark, [("block", "com", "/" * n) for n in range(5)]))
    except ValueError as error:
        assert "shapes" in str(error)
    else:
        raise AssertionError("rules of too many shapes were taken")
