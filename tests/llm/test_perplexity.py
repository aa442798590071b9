import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from daybook.llm import perplexity as K

SF = "/root/testdata/sf0.01"
TEXTS = ["the cat sat on the mat", "The dog 12 sat, the dog sat.", "a cat and a dog", "on and on", "tthhee"]


def plain_model(texts, order, classes, vocabulary):
    """p(context tuple, character) of interpolated modified Kneser-Ney, straight from its definition."""
    levels = [None] * (order + 1)
    top = Counter()
    for t in texts:
        seq = [K.START] * (order - 1) + [int(classes[ord(c)]) for c in t]
        top.update(tuple(seq[i : i + order]) for i in range(len(t)))
    levels[order] = top
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])

    def discount(c, k):
        n = [sum(v == x for v in levels[k].values()) for x in (1, 2, 3, 4)]
        if 0 in n:
            return [0.5, 1.0, 1.5][min(c, 3) - 1]
        y = n[0] / (n[0] + 2 * n[1])
        j = min(c, 3)
        d = j - (j + 1) * y * n[j] / n[j - 1]
        return d if 0 < d < j else 0.5 * j

    followers = [defaultdict(dict) for _ in levels]
    for k in range(1, order + 1):
        for g, c in levels[k].items():
            followers[k][g[:-1]][g[-1]] = c

    def p(context, ch):
        k = len(context) + 1
        under = p(context[1:], ch) if context else 1 / vocabulary
        own = followers[k].get(context)
        if not own:
            return under
        total, mass = sum(own.values()), sum(discount(c, k) for c in own.values())
        c = own.get(ch, 0)
        return ((c - discount(c, k)) if c else 0) / total + mass / total * under

    return p


def test_model_equals_the_definition_and_is_normalised(spark):
    classes, table = K.fit(spark.createDataFrame([(t,) for t in [*TEXTS, None, ""]], "text string"))
    seen = sorted({int(classes[ord(c)]) for t in TEXTS for c in t})
    frequent = [c for c in seen if c >= K.FIRST]
    vocabulary = K.FIRST - 1 + len(frequent)
    p = plain_model(TEXTS, K.ORDER, classes, vocabulary)
    possible = [K.CAPITAL, K.DIGIT, K.OTHER, *frequent]
    for context in [(K.START,) * 3, (K.START, K.START, seen[-1]), tuple(seen[-3:]), tuple(int(classes[ord(c)]) for c in "the"), (K.OTHER,) * 3]:
        row = [math.exp(table[((context[0] << 12 | context[1] << 6 | context[2]) << 6) | c]) for c in possible]
        assert row == pytest.approx([p(context, c) for c in possible], rel=1e-4)
        assert sum(row) == pytest.approx(1, abs=1e-4)


def test_query_separates_the_labels(spark):
    from daybook.llm.registry import queries

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = queries()["op5_perplexity"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id", "left").collect()
    assert len(rows) == docs.count()
    good, bad = [r for r in rows if r.quality == 1 and r.toxic == 0], [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert sum(not r.kept for r in bad) >= 0.4 * len(bad)
    assert {r.threshold for r in rows if r.lang == "en"} != {r.threshold for r in rows if r.lang == "fr"}


def test_trusted_documents_without_a_label_are_kept(spark):
    """With half of the labels, documents as good as the labelled ones but unseen by the model are kept as often."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    half = labels.where("doc_id % 2 = 0")
    rows = K.classify(docs.select("doc_id", "text", "lang"), half).join(labels, "doc_id").collect()
    unseen = [r for r in rows if r.doc_id % 2 and r.quality == 1 and r.toxic == 0]
    bad = [r for r in rows if r.quality == 0]
    assert len(unseen) > 100 and sum(r.kept for r in unseen) >= 0.95 * len(unseen)
    assert sum(not r.kept for r in bad) >= 0.9 * len(bad)


def test_perplexity_of_each_document(spark):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string, kept int")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(5)] * 2, "doc_id long, quality int, toxic int")
    model = K.fit(docs.select("text"))
    classes, table = model
    logs = [sum(float(table[c]) for c in K.ngram_codes(classes[K.code_points(t)])) for t in TEXTS]
    mean = sum(logs) / sum(map(len, TEXTS))
    for r in K.classify(docs, labels).collect():
        want = math.exp(-(logs[r.doc_id] + K.SHRINK * mean) / (len(r.text) + K.SHRINK))
        assert r.perplexity == pytest.approx(want, rel=1e-5) and r.kept and r.n_symbols == len(r.text)


def test_odd_rows(spark):
    rows = [(None, None, None), (1, "", "en"), (2, "plain words here", None), (2, "plain words here", None), (3, "z" * 3000000, "zz"), (None, "no id", "en"), (4, "good words here", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(4, 1, 0), (2, 1, 0), (2, 0, 0), (None, 1, 0), (9, 1, 1)], "doc_id long, quality int, toxic int")
    got = K.classify(docs, labels).collect()
    assert len(got) == len(rows) and all(not r.kept and r.perplexity is None for r in got if not r.text)
    assert all(r.threshold is not None for r in got) and not [r for r in got if r.doc_id == 3][0].kept
    none = K.classify(docs, labels.where("false")).collect()
    assert all(r.kept == bool(r.text) and r.perplexity is None for r in none)
    assert K.classify(docs.where("false"), labels).count() == 0


def test_a_script_beyond_the_frequent_classes(spark):
    """83 frequent letters of three scripts, and a minority in a script of its own: real n-grams, not one class."""
    rnd = random.Random(4)
    common = [chr(c) for c in range(0x3B1, 0x3CA)] + [chr(c) for c in range(0x61, 0x7B)] + [chr(c) for c in range(0x430, 0x450)]
    words = ["".join(rnd.choices(common, k=5)) for _ in range(80)]
    hanzi = ["\u4f60\u597d\u4e16\u754c", "\u5929\u5730\u4eba", "\u6c34\u706b\u5c71\u77f3"]
    texts = [" ".join(rnd.choices(words, k=30)) for _ in range(12)] + [" ".join(rnd.choices(hanzi, k=12)) for _ in range(3)]
    classes, table = K.fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    frequent = {c for t in texts for c in t}
    assert len(frequent) > 64 and len({int(classes[ord(c)]) for c in frequent}) == len(frequent)
    vocabulary = K.FIRST - 1 + len(frequent)
    p = plain_model(texts, K.ORDER, classes, vocabulary)
    clean = " ".join(hanzi)
    garbled = "".join(rnd.sample(clean, len(clean)))
    got = {}
    for t in [clean, garbled, texts[0], texts[0] + clean, clean + "\u9f8d" + texts[1]]:
        ids = [K.START] * (K.ORDER - 1) + [int(classes[ord(c)]) for c in t]
        want = sum(math.log(p(tuple(ids[i : i + K.ORDER - 1]), ids[i + K.ORDER - 1])) for i in range(len(t)))
        got[t] = table.total(classes[K.code_points(t)])
        assert got[t] == pytest.approx(want, rel=1e-4)
    assert got[garbled] < 2 * got[clean]


def test_codes():
    assert K.ngram_codes(np.array([5, 6], np.uint8)).tolist() == [(((3 << 6 | 3) << 6 | 3) << 6) | 5, (((3 << 6 | 3) << 6 | 5) << 6) | 6]


def test_all_trusted_documents_are_counted(spark, monkeypatch):
    """No document is left out of the model, however many are trusted; the dense table is not sent."""
    import pickle

    docs = spark.range(6000).selectExpr("id AS doc_id", "'plain words' AS text", "'en' AS lang")
    labels = docs.selectExpr("doc_id", "1 AS quality", "0 AS toxic")
    seen, fit = [], K.fit
    monkeypatch.setattr(K, "fit", lambda texts, *a: (seen.append(texts.count()), fit(texts, *a))[1])
    assert K.classify(docs, labels).where("kept").count() == 6000
    assert seen[0] == 6000 and sum(seen[1:]) == 6000
    _, table = fit(docs.limit(1))
    sent = pickle.dumps(table)
    assert len(sent) < 1 << 20 and (pickle.loads(sent).dense == table.dense).all()


def test_trusted_texts_are_taken_without_an_exchange_of_texts(spark):
    rows = spark.range(-2000, 6000).selectExpr("id", "concat('text ', id) AS text")
    rows = rows.unionByName(spark.createDataFrame([(None, "null"), (3, "again"), (3, "again")], "id long, text string"))
    ids = spark.range(0, 5000, 3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        got = K.with_ids(rows, ids)
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange hashpartitioning" not in plan
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.join(ids, "id", "left_semi").collect()))
    assert K.with_ids(rows, ids.where("id < 0")).count() == 0
    text_ids = rows.selectExpr("cast(id AS string) AS id", "text")
    assert K.with_ids(text_ids, ids).count() == got.count()


def test_the_driver_holds_no_dense_table(spark):
    """The model takes less than 64 MB there, also while it is made; only who scores fills the table."""
    import tracemalloc

    texts = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    tracemalloc.start()
    try:
        _, table = K.fit(texts)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 4 * 64**K.ORDER and "dense" not in vars(table)
    assert len(table.dense) == 64**K.ORDER and "dense" in vars(table)
