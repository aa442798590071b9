from collections import Counter

import numpy as np
import pytest

from daybook.llm import langid as G


def plain_profile(texts, n):
    c = Counter()
    for t in texts:
        word = ""
        for ch in t.lower() + " ":
            if G.letters()[ord(ch)]:
                word += ch
            elif word:
                s = f"\x01{word}\x01"
                c.update(word)
                c.update(s[i : i + 2] for i in range(len(s) - 1))
                c.update(s[i : i + 3] for i in range(len(s) - 2))
                word = ""
    code = lambda g: sum(ord(x) << (21 * (len(g) - 1 - i)) for i, x in enumerate(g))
    return [code(g) for g, _ in sorted(c.items(), key=lambda x: (-x[1], code(x[0])))[:n]]


def plain_predict(t, profiles, n):
    own = plain_profile([t or ""], n) if any(map(str.isalpha, t or "")) else []
    if not own or not profiles:
        return "und", 0.0
    far = {k: sum(abs(p.index(g) - i) if g in p else n for i, g in enumerate(own)) for k, p in profiles.items()}
    best = min(sorted(far), key=far.get)
    return best, 1.0 - far[best] / (n * len(own))


TEXTS = [None, "", "123 !?", "\u0301", "a", "That it.", "été çà", "ß" * 5000, "漢字 かな", "aa bb aa", "É é É", "x\x01y", "🎉a🎉"]


def test_against_plain_counting(spark, monkeypatch):
    train = [("the thing of that and the other thing", "en"), ("der die das und nicht", "de"), ("le la les des était", "fr"), ("zz", None), (None, "en"), ("12", "xx")]
    profiles = G.fit(spark.createDataFrame(train, "text string, lang string"), ranks=30)
    plain = {k: plain_profile([t for t, x in train if x == k and t], 30) for k in ("de", "en", "fr")}
    assert {k: list(v) for k, v in profiles} == plain
    df = spark.createDataFrame([(t, "clash") for t in TEXTS + TEXTS], "text string, score string")
    for r in G.identify(df, profiles, ranks=30).collect():
        want = plain_predict(r.text, plain, 30)
        assert (r.lang_pred, r.score) == (want[0], pytest.approx(want[1]))


def test_long_texts_count_the_same_in_pieces(monkeypatch):
    runs = G.letter_runs("une phrase assez longue pour plusieurs morceaux " * 9)
    whole = G.counted(runs)
    for size in (7, 10, 64):
        monkeypatch.setattr(G, "CHUNK", size)
        got = G.counted(runs)
        assert np.array_equal(got[0], whole[0]) and np.array_equal(got[1], whole[1])


def test_held_out_accuracy_of_the_query(spark):
    from daybook.llm.registry import queries

    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries()["op9_langid"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got.values())
    held = [d for d in docs if got[d.doc_id].held_out]
    assert 0.1 * len(docs) < len(held) < 0.3 * len(docs)
    assert sum(got[d.doc_id].lang_pred == d.lang for d in held) >= 0.97 * len(held)


def test_nothing_to_learn_or_judge(spark):
    assert G.fit(spark.createDataFrame([], "text string, lang string")) == []
    assert G.identify(spark.createDataFrame([], "text string"), []).count() == 0
    assert G.identify(spark.createDataFrame([("abc",)], "text string"), []).first().lang_pred == "und"
