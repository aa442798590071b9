import html
import random
import re

import pytest
from pyspark.sql import functions as F

from daybook.llm import extract as X

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def forest(spark):
    return X.fit(spark.read.parquet(f"{SF}/pages.parquet"), train_pages=100)


def article_text(source):
    """Blocks of the one article element, whose markup the tables keep simple."""
    inner = re.search(r"<article>(.*?)(?:</article>|<footer>)", source, re.S).group(1)
    blocks = re.split(r"</?(?:h1|p|br|article)\b[^>]*>", inner)
    return " ".join(" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)) for b in blocks).split())


def test_query_gives_the_articles(spark):
    from daybook.llm.registry import queries

    got = {r.page_id: r for r in queries()["op1_extract"](spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    wrong = [p.page_id for p in pages if got[p.page_id].text != article_text(p.html)]
    assert len(wrong) <= 0.01 * len(pages)
    assert all(r.n_chars == len(r.text) for r in got.values())


def kept_text(page, kept):
    return X.main_text(page, kept)


def test_held_out_layouts(forest):
    good = total = 0
    words = [f"{a}{b}" for a in ("ba", "ke", "lo", "mi") for b in ("ra", "tun", "so", "x", "")]
    for seed in range(300):
        page = X.parse(X.layout(random.Random(10**6 + seed), words))
        want = [bool(x) for x in X.labels(page)]
        got = X.decode(page, forest.probability(X.features(page)))
        for t, a, b in zip(page.text, want, got):
            if t is not None:
                total += len(t)
                good += len(t) * (a == b)
    assert good >= 0.97 * total


def best_by_force(page, p):
    import itertools
    import math

    best, kept = -math.inf, None
    for bits in itertools.product([True, False], repeat=len(page.tag) - 1):
        k = [True, *bits]
        if all(not k[i] or k[page.parent[i]] for i in range(1, len(k))):
            score = sum(math.log(p[i] if k[i] else 1 - p[i]) for i in range(1, len(k)))
            if score > best:
                best, kept = score, k
    return kept


def test_decoding_is_the_best_consistent_choice():
    rnd = random.Random(3)
    import numpy as np

    page = X.parse("<body><div><p>a</p>b<p>c</p></div><ul><li>d<li>e</ul></body>")
    for _ in range(30):
        p = np.array([rnd.uniform(0.05, 0.95) for _ in page.tag])
        assert X.decode(page, p) == best_by_force(page, p)


@pytest.mark.parametrize("source,text", [
    ("<p>a<b>b</b>c<br>d</p>", "abc d"), ("<p>x &amp; y &eacute;&#233; &am", "x & y éé &am"), ("a < b", "a < b"), ("<p>one<p>two", "one two"),
    ("<script>var x='<p>no</p>'</script>yes<!-- no", "yes"), ("<style>p{}</style><p title='a>b'>t</p>", "t"), ("<head><title>n</title><body>b", "b"),
    ("<ul><li>a<li>b</ul>c", "a b c"), ("</p></div>x", "x"), ("<div>a\n\n \tb</div>\xa0c", "a b c"), ("<p>a</p> b <i>c</i>", "a b c"), ("", ""),
    ("foo<span class=icon></span> <b>bar</b>", "foo bar"), ("x<a name=t></a> <i>y</i>", "x y"), ("a<b>b</b>c", "abc"), ("a<wbr>b", "ab"),
    ("a<script>x</script>b <style>y</style> c", "ab c"), ("<p>one<script>x</script>two</p>", "onetwo"),
    ('a<img title="5" tall" src=x>b c', "a b c"), ('<a href="x>y" title=\'>\'>t</a>', "t"), ("<p title=it's>t</p> u", "t u"), ('<p x="no end>t', "t"), ("t</1 </2", "t"),
])
def test_reading_of_markup(source, text):
    page = X.parse(source)
    assert X.main_text(page, [True] * len(page.tag)) == text


def test_blanks_beside_dropped_runs_stay():
    page = X.parse("<p>a<b>drop</b> <i>c</i></p>")
    drop = next(k for k, t in enumerate(page.text) if t and t.strip() == "drop")
    kept = [k != drop and k != page.parent[drop] for k in range(len(page.tag))]
    assert X.main_text(page, kept) == "a c"


def test_hostile_pages_take_time_in_proportion():
    import time

    for piece in ("</1 ", "<a ='", "<p =\"x", "<!-", "<b c='d' ", "< "):
        start = time.perf_counter()
        X.parse(piece * (1_000_000 // len(piece)))
        assert time.perf_counter() - start < 30, piece


def test_copies_of_a_page_count_once_in_the_sample(spark):
    pages = [f"<html><body><article><p>{' '.join(f'w{i}x{k}' for k in range(60))}</p></article></body></html>" for i in range(6)]
    rows = [(p,) for p in [pages[0]] * 50 + pages]
    assert X.fit(spark.createDataFrame(rows, "html string"), train_pages=6) is not None


def test_odd_pages(spark, forest):
    rows = [(1, None), (None, ""), (2, "   "), (3, "<div>" * 20000 + "deep"), (4, "<p>" + "long text, really. " * 50000), (4, None), (5, "\x00<"), (6, "<html></html>")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, html string, text string")
    got = X.extract(df, forest).collect()
    assert len(got) == len(rows) and all(r.text is not None and r.n_chars == len(r.text) for r in got)
    assert all(r.text == "" for r in got if not r.html or r.html.isspace())


def test_input_pages_may_have_any_data_label(spark, forest):
    body = "<body><div class=menu><a href=/>home</a></div><article><p>" + "long text, really. " * 20 + "</p><table><tr><td{}>1</td></tr></table></article></body>"
    rows = [(i, body.format(a)) for i, a in enumerate(["", ' data-label="Price"', " data-label", ' data-label=""', ' data-label="0"', ' data-label="1"'])]
    df = spark.createDataFrame(rows, "page_id long, html string")
    got = X.extract(df, forest).collect()
    assert len(got) == len(rows) and len({r.text for r in got}) == 1 and "long text" in got[0].text
    assert X.fit(df) is not None


def test_nothing_to_train_on(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert X.fit(empty) is None
    assert X.extract(empty, None).count() == 0
    assert X.fit(spark.createDataFrame([("<p></p>",)], "html string")) is None
    assert X.extract(spark.createDataFrame([("<p>a</p>",)], "html string"), None).first().text == ""
    assert X.fit(empty.where(F.lit(False))) is None
