import pytest
from pyspark.sql import functions as F

from daybook.llm import url_filter as U


def brute(url, rules):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[3] if fits else None, max(fits)[2] if fits else "allow")


URLS = [
    None, "", "no scheme/en/", "http://a.COM", "http://a.com/", "https://example.com/en/1?x=/fr/", "http://www.EXAMPLE.com/en/9#a/b",
    "http://x.www.example.com/en/", "http://b.net/es/é", "http://b.net/ES/", "http://com/", "http://xcom/", "http://n.net?/es/",
    "http://b.net/fr/" + "y" * 5000, "http://a..com/x", "ftp://u@h.com:80/p://q", "http://b.net/fr\n/z", "http://a.com/", "://com/x",
    "http://" + "a." * 4000 + "com/en/", "http://" + "b." * 3000 + "www.example.com/en/x",
]


@pytest.mark.parametrize("rules", [U.RULES, [], [("com", "", "block"), ("com", "", "allow"), ("b.net", "/f", "block"), ("", "", "block")]])
def test_against_brute_force(spark, rules):
    rows = [(i if i % 5 else None, u, "clash") for i, u in enumerate(URLS)]
    df = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    got = U.filter_urls(df, U.rule_table(spark, rules)).select("url", "host", "path", "rule", "verdict").collect()
    assert sorted(map(str, ((r.url, *r[1:]) for r in got))) == sorted(str((u, *brute(u, rules))) for u in URLS)


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string")
    assert U.filter_urls(df, U.rule_table(spark, U.RULES)).count() == 0


def test_no_python_in_plan(spark):
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string").where(F.col("page_id") > 0)
    plan = U.filter_urls(df, U.rule_table(spark, U.RULES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
