import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import divergence as D

SF = "/root/testdata/sf0.01"
WORD = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SCHEMA = "text string, lang string, source string"


def terms(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(rows, min_docs, top=50):
    rows = [(terms(t), lang or "", source or "") for t, lang, source in rows]
    out = []
    for lang in {r[1] for r in rows}:
        own = {s: Counter() for _, x, s in rows if x == lang}
        docs = Counter()
        for t, x, s in rows:
            if x == lang:
                own[s].update(t)
                docs.update(set(t))
        kept = [w for w, n in docs.items() if n >= min_docs]
        whole = Counter()
        for c in own.values():
            whole.update({w: c[w] for w in kept})

        def share(c):
            n = sum(c[w] for w in kept)
            return {w: 1 + 10**9 * (c[w] + 5) // (n + 5 * len(kept)) for w in kept}

        p, q = {s: share(c) for s, c in own.items()}, share(whole)
        for s in own:
            apart = [(sum(abs(p[s][w] - p[o][w]) for w in kept), o) for o in own if o != s]
            more = [(p[s][w] - q[w], w) for w in kept if own[s][w] and p[s][w] > q[w]]
            for part, found, most in (("pair", apart, len(apart)), ("term", more, top)):
                found.sort(key=lambda f: (-f[0], f[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found[:most])]
    return sorted(out)


def corpus(n, sources=7):
    rnd = random.Random(3)
    vocab = ["the", "The", "naïve", "日本", "x1y", "a", "b-c", "É", "é", *[f"w{chr(97 + i)}" for i in range(20)]]
    rows = []
    for i in range(n):
        lang = rnd.choice(["en", "en", "en", "de", None, ""])
        weight = [1 / (1 + (k + i % sources) % len(vocab)) for k in range(len(vocab))]
        rows.append((" ".join(rnd.choices(vocab, weight, k=rnd.randrange(0, 30))), lang, None if i % sources == 0 else f"s{i % sources}"))
    return rows + rows[:5] + [(None, "en", "empty"), ("", "fr", "a"), ("12 34", "fr", "b"), ("one", "fr", None), (None, None, None)]


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({"term": F.lit(1), "n": F.lit("x"), "value": F.lit(2)})
    return sorted(tuple(r) for r in D.audit(df, **kw).collect())


@pytest.mark.parametrize("kw", [{}, {"block": 10, "fan_in": 3, "top": 3}])
def test_against_the_definition(spark, kw):
    rows = corpus(150)
    assert run(spark, rows, min_docs=12, **kw) == plain(rows, 12, kw.get("top", 50))


def test_tiles_of_sources(spark, monkeypatch):
    monkeypatch.setattr(D, "TILE", 3)
    rows = corpus(200, 11)
    assert run(spark, rows, min_docs=10) == plain(rows, 10)


def test_very_long_text(spark):
    long = "Alpha beta " * 600_000 + "gamma"
    rows = [(long, "en", "a"), ("beta gamma", "en", "b"), ("delta", "en", "b")]
    assert run(spark, rows, min_docs=2) == plain(rows, 2)


def test_no_terms_kept_and_empty(spark):
    rows = corpus(20)
    got = run(spark, rows, min_docs=10**6)
    assert got == plain(rows, 10**6) and all(r[4] == 0 for r in got)
    assert run(spark, [], min_docs=1) == []


def test_shares_are_exact():
    counts = np.array([0, 1, 7, 10**12, 3 * 10**14])
    whole = np.array([5, 17, 12, 10**12 + 35, 9 * 10**14])
    assert D.shares(counts, whole).tolist() == [1 + 10**9 * (int(c) + 5) // int(w) for c, w in zip(counts, whole)]


def test_query(spark):
    from daybook.llm.registry import queries

    got = sorted(tuple(r) for r in queries()["op12_divergence"](spark, SF).collect())
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang", "source").collect()
    assert got == plain([tuple(r) for r in docs], 30)


def test_merge_of_runs_in_blocks(monkeypatch):
    monkeypatch.setattr(D, "STEP", 3)
    rnd, want, rows = random.Random(4), Counter(), []
    for run in range(6):
        block = D.Block()
        for _ in range(30):
            source, words = rnd.choice("xyz"), rnd.choices(["a", "b", "c", "dd", "ddd", "e", "ff"], k=rnd.randrange(9))
            block.add("en", source, " ".join(words).encode())
            want.update((w.encode(), source) for w in words)
        rows += list(block.spill(run, 1))
    table = D.pa.Table.from_batches(rows)
    names, got, last = D.names_in(table), Counter(), b""
    for part in D.merged(table):
        part = D.summed(part)
        terms = part["terms"].to_pylist()
        assert terms == sorted(terms) and (not terms or last < terms[0])
        last = terms[-1]
        got.update(dict(zip(zip(terms, [names[k] for k in part["source"].to_pylist()]), part["n"].to_pylist())))
    assert got == want
