import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import katz as K

SF = "/root/testdata/sf0.01"


def tokens(t):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) + ["\n"]


class Plain:
    """The model from its definition, in memory, one token at a time."""

    def __init__(self, texts):
        self.one, self.two, self.history = Counter(), Counter(), Counter()
        for t in texts:
            w = tokens(t)
            self.one.update(w)
            self.two.update(zip(["<s>", *w], w))
            self.history.update(["<s>", *w[:-1]])
        self.n, self.v = sum(self.one.values()), len(self.one)
        self.d1, self.d2 = self.discount(self.one), self.discount(self.two)
        self.followers = {}
        for (h, w), c in self.two.items():
            self.followers.setdefault(h, []).append((w, c))
        self.alpha = {}

    @staticmethod
    def discount(counts):
        """Good-Turing's own share of each count; the fit's where that is not in (0, 1); (r - 1/2)/r without a fit."""
        by = Counter(counts.values())
        n = [by[r] for r in range(1, 7)]
        plain = {r: (r - 0.5) / r for r in range(1, 6)}
        if 0 in n:
            return plain
        slope = np.polyfit(np.log(range(1, 7)), np.log(n), 1)[0] + 1
        out = {}
        for r in range(1, 6):
            a, b = 6 * n[5] / n[0], 6.0**slope
            own = ((r + 1) * n[r] / (r * n[r - 1]) - a) / (1 - a) if a < 1 else 0
            fit = ((1 + 1 / r) ** slope - b) / (1 - b) if b < 1 else 0
            out[r] = next(float(x) for x in (own, fit, plain[r]) if 0 < x < 1)
        return out

    @staticmethod
    def kept(c, d):
        return c * d[c] if c <= 5 else c - K.EPSILON

    def p1(self, w):
        if w in self.one:
            return self.kept(self.one[w], self.d1) / self.n
        return 1 - sum(self.kept(c, self.d1) for c in self.one.values()) / self.n if self.n else 1.0

    def p(self, h, w):
        if h not in self.history:
            return self.p1(w)
        if (h, w) in self.two:
            return self.kept(self.two[h, w], self.d2) / self.history[h]
        if h not in self.alpha:
            own = self.followers[h]
            left = 1 - sum(self.kept(c, self.d2) for _, c in own) / self.history[h]
            self.alpha[h] = left / (1 - sum(self.p1(x) for x, _ in own))
        return self.alpha[h] * self.p1(w)

    def row(self, t):
        w = tokens(t)
        base = sum(math.log10((self.one[x] + 0.1) / (self.n + 0.1 * (self.v + 1))) for x in w)
        return len(w), sum(x in self.one for x in w), self.n, base, sum(math.log10(self.p(h, x)) for h, x in zip(["<s>", *w], w))


def corpus(n):
    rnd = random.Random(9)
    vocab = [f"w{i}" for i in range(60)]
    make = lambda k: " ".join(rnd.choices(vocab, [1 / (i + 1) for i in range(60)], k=k))
    return [(i if i % 7 else None, make(rnd.randrange(0, 60)) + rnd.choice(["", " RARE%d" % i, "\tÉ É", " "])) for i in range(n)] + [(1, None), (1, ""), (2, "x " * 5000)]


def taught(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 != 0


@pytest.mark.parametrize("sample,spread", [(1, 4096), (1, 3), (10**6, 4096)])
def test_against_the_definition(spark, tmp_path, sample, spread):
    rows = corpus(150)
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, score int").repartition(3)
    got = K.score_documents(df, K.remainder(F.col("doc_id")) != 0, model=f"{tmp_path}/m", sample=sample, spread=spread).collect()
    plain = Plain([t for i, t in rows if taught(i)])
    key = lambda x: (x[0] is None, x)
    want = sorted(((i, *plain.row(t)) for i, t in rows), key=key)
    have = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=key)
    assert [x[:4] for x in have] == [x[:4] for x in want]
    for a, b in zip(have, want):
        assert a[4:] == pytest.approx(b[4:], rel=1e-9, abs=1e-9)


def test_definition_is_normalised():
    plain = Plain([t for i, t in corpus(150) if taught(i)])
    words = [*plain.one, "never seen"]
    for h in ["<s>", "w0", "w1", "w40", "rare5", "unknown history", "é"]:
        assert sum(plain.p(h, w) for w in words) == pytest.approx(1, abs=1e-9)


def test_query(spark):
    from daybook.llm.registry import queries

    got = {r.doc_id: r for r in queries()["op2_katz"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    plain = Plain([d.text for d in docs if taught(d.doc_id)])
    assert len(got) == len(docs)
    for d in docs:
        r = got[d.doc_id]
        n, known, total, base, score = plain.row(d.text)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (not taught(d.doc_id), n, known, total)
        assert (r.base_score, r.score) == (pytest.approx(base, rel=1e-9), pytest.approx(score, rel=1e-9))
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_nothing_to_learn_or_score(spark):
    df = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    assert all(r.score == 0 and r.base_score == pytest.approx(0) and r.train_tokens == 0 for r in K.score_documents(df, F.lit(False)).collect())
    assert K.score_documents(df.where("false"), F.lit(True)).count() == 0


def test_packing():
    arrays = [np.array([], np.int64), np.array([5, -1, 2**62]), np.arange(300, dtype=np.uint16), np.array([0.5, 1e300])]
    for a, b in zip(arrays, K.unpack(K.pack(*arrays))):
        assert a.dtype == b.dtype and np.array_equal(a, b)
