from hypothesis import given, settings
from hypothesis import strategies as st

import llm_helpers  # noqa: F401

from tickloom.llm import url_filter
from tickloom.llm.queries import URL_RULES


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    ends = [rest.find(c) for c in "/?#" if c in rest]
    host, after = (rest[:min(ends)], rest[min(ends):]) if ends else (rest, "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = after.split("?")[0].split("#")[0]
    fits = []
    for verdict, rule in rules:
        name, slash, p = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + p):
            fits.append((len(rule), len(name), verdict == "block", rule, verdict))
    best = max(fits) if fits else None
    return host, path, best[3] if best else None, best[4] if best else default


URLS = [
    "http://a.net/x", "HTTP://A.Example.NET/en/1?q", "https://example.net/en", "https://example.net", "http://net", "http://net/",
    "http://xnet/", "http://example.com/de/#a", "http://www.example.com/dex", "ftp://b.org/fr/", "http://org/fr/a", "no scheme",
    "", None, "://", "http://?a=http://net/", "http://a.b.c.d.e.f.net/" + "x" * 5000, "http://a.net/x", "http://ÄÖ.net/", "http://.net/",
]


def check(spark, urls, rules):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_filter.judge_urls(df, url_filter.rules_table(spark, rules)).collect()
    assert sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == sorted(
        ((i, *brute(u, rules)) for i, u in enumerate(urls)), key=lambda r: r[0])


def test_cases(spark):
    check(spark, URLS, URL_RULES)


def test_no_rules(spark):
    check(spark, URLS, ())


def test_ties_and_odd_rules(spark):
    check(spark, URLS, (("allow", "net/"), ("block", "net/"), ("allow", "a.net"), ("block", "/x"), ("block", "example.net/e")))


host = st.sampled_from(["net", "a.net", "example.net", "www.example.com", "org", "x.org", ""])
path = st.text("/enfrd?#", max_size=6)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(host, path), min_size=1, max_size=40))
def test_random(spark, parts):
    check(spark, [f"http://{h}/{p}" for h, p in parts], URL_RULES)


def test_empty_and_clashing_columns(spark):
    rules = url_filter.rules_table(spark, URL_RULES)
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string"), rules).count() == 0
    df = spark.createDataFrame([(1, "http://a.net/", "h", 7, "v", 9)], "page_id long, url string, host string, short int, verdict string, digest int")
    row = url_filter.judge_urls(df, rules).first()
    assert (row.page_id, row.host, row.short, row.digest, row.verdict, row.rule) == (1, "a.net", 7, 9, "block", "net/")


def test_no_python_in_plan(spark):
    df = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert "Python" not in url_filter.judge_urls(df, url_filter.rules_table(spark, URL_RULES))._jdf.queryExecution().toString()
