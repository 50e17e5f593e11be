"""URL filter: parts and rules against plain Python, trees on held-out URLs, odd rows."""

import re

import pytest
from pyspark.sql import functions as F

from staylens.llm import urls as U
from staylens.llm.queries import QUERIES, URL_RULES

SF = "/root/testdata/sf0.001"
ODD = [None, "", "no scheme.com/en/", "http://", "HTTP://WWW.Example.COM/en/x", "http://a.com", "http://a.com?x=/en/", "http://net/fr/",
       "ftp://x.y.net/es/a#b://c.com/", "http://notcom/", "http://a.net/ES/", "x://y\nz.com/p?q", "http://example.com/en/://b.net/es/", "http://h/" + "a1%" * 50_000]


def plain(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for verdict, rule in URL_RULES:
        at, rest = rule.split("/", 1)
        if (host == at or host.endswith("." + at)) and path.startswith("/" + rest) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return host, path, best


def test_parts_and_rules(spark):
    urls = ODD + [r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    for r in U.judge(df, URL_RULES).collect():
        host, path, best = plain(urls[r.id])
        assert (r.host, r.path, r.rule) == (host, path, best and best[1]), urls[r.id]
        assert r.verdict in ("allow", "block") and (best is None or r.verdict == best[0])
        assert 0 <= r.block_score <= 1


def test_every_page_once(spark):
    got = QUERIES["op3_url_filter"](spark, SF).collect()
    assert sorted(r.page_id for r in got) == sorted(r.page_id for r in spark.read.parquet(f"{SF}/pages.parquet").collect())


def test_features(spark):
    df = spark.createDataFrame([("http://ab-c.d.com/x1/y.html?p=1&q=2#z",), ("",)], "url string")
    rows = U.features(df.withColumns({"host": U.host_of(F.col("url")), "path": U.path_of(F.col("url"))})).collect()
    r = rows[0]
    assert (r.labels, r.depth, r.parameters, r.pairs, r.hyphens, r.dots, r.fragment, r.suffix, r.domain) == (3, 2, 2, 2, 1, 1, 1, "com", "d.com")
    assert r.digits == pytest.approx(3 / 37) and 3.5 < r.entropy < 4.8 and rows[1].entropy == 0


def test_trees_learn_from_labelled_urls(spark):
    def url(i):
        return f"http://shop{i % 50}.site{i}.org/{'a' * (i % 7)}/{'9' * 12 if i % 3 == 0 else 'page'}{i}?u={i}", int(i % 3 == 0)

    labelled = spark.createDataFrame([url(i) for i in range(100, 999) if i % 4], "url string, label int")
    fresh = spark.createDataFrame([(i, *url(i)) for i in range(100, 999) if i % 4 == 0], "page_id long, url string, label int")
    got = {r.id: r.verdict for r in U.judge(fresh, [], labelled).collect()}
    assert sum((got[i] == "block") == (i % 3 == 0) for i in got) > 0.97 * len(got)


def test_empty_and_one_sided(spark):
    df = spark.createDataFrame([(None, None), (1, "http://a.org/"), (1, "http://a.org/")], "page_id long, url string")
    got = U.judge(df, URL_RULES).collect()
    assert len(got) == 3 and all((r.verdict, r.block_score, r.rule) == ("allow", 0.0, None) for r in got)
    assert U.judge(df.limit(0), URL_RULES).count() == 0


def test_statistics_count_all_labelled_urls(spark):
    rows = [(f"http://h{i}.site{i % 40}.org/p{i}", 0) for i in range(2000)] + [(f"http://x.bad.org/q{i}", 1) for i in range(3)]
    model = U.UrlModel(spark.createDataFrame(rows, "url string, label int"), sample=20, trees=2)
    assert model.model is not None  # both verdicts are there, whatever the share of one
    domain = {r.domain: (r.domain_share, round(float(2.718281828459045**r.domain_count)) - 1) for r in model.statistics[1].collect()}
    assert len(domain) == 41 and domain["bad.org"][1] == 3 and all(domain[f"site{i}.org"][1] == 50 for i in range(40))
    assert domain["bad.org"][0] == pytest.approx(5.5 / 8) and domain["site1.org"][0] == pytest.approx(2.5 / 55)
    assert [r.suffix_count for r in model.statistics[0].collect()] == [pytest.approx(7.602900)]
