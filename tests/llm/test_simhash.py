import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from daybook.llm import simhash as S


def plain_fingerprint(t, shingle=4):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + shingle]).encode(), 42) for i in range(max(1, len(w) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_classes(rows, distance=4):
    """(row, fingerprint, smallest id reachable)"""
    prints = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= distance:
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return [(d, t, f"{prints[i]:016x}", least.get(find(i))) for i, (d, t) in enumerate(rows)]


def test_golay_code_is_perfect():
    home, near = S.patterns()
    words = set(S.golay_words().tolist())
    assert len(words) == 4096 and (home[1:] != 0).all() and home[0] == 0
    some = np.random.default_rng(1).integers(0, 1 << 23, 500)
    assert all((int(x) ^ int(home[s])) in words for x, s in zip(some, S.syndromes(some)))
    assert sum(map(len, near)) == sum(1 for n in range(5) for _ in combinations(range(23), n))


def test_any_pair_within_four_bits_meets_at_an_anchor():
    rnd = random.Random(3)
    for _ in range(3000):
        x = rnd.getrandbits(64)
        y = x ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(1, 5)))
        index, keys = S.anchor_keys(np.array([x, y], np.uint64).view(np.int64))
        assert set(keys[index == 0].tolist()) & set(keys[index == 1].tolist())


@pytest.mark.parametrize("cell,small", [(4096, 8), (5, 2)])
def test_links_connect_like_all_pairs(spark, monkeypatch, cell, small):
    monkeypatch.setattr(S, "CELL", cell)
    rnd = random.Random(7)
    centres = [rnd.getrandbits(64) for _ in range(6)]
    prints = {c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(0, 6))) for c in centres for _ in range(40)} | {rnd.getrandbits(64) for _ in range(200)}
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    df = spark.createDataFrame([(p,) for p in signed + signed], "p long")
    got = {r.node: r.label for r in S.components(S.link(df, "p")).collect()}
    root = {p: p for p in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(signed, 2):
        if (np.uint64(np.int64(a).view(np.uint64)) ^ np.int64(b).view(np.uint64)).item().bit_count() <= 4:
            lo, hi = sorted((find(a), find(b)))
            root[hi] = lo
    assert {p: got.get(p, p) for p in signed} == {p: find(p) for p in signed}


BASE = " ".join(f"w{i}" for i in range(400))
TEXTS = [(3, None), (9, ""), (None, " \n"), (5, "one two"), (4, "ONE  two"), (8, "a"), (7, BASE), (6, BASE.upper()), (6, BASE), (2, BASE.replace("w200", "x")),
         (None, "null id only"), (None, "null id only"), (1, "É é Ünï"), (10, "x " * 40000), (11, "x " * 39999 + "y")]


def test_classes_against_brute_force(spark):
    df = spark.createDataFrame([(d, t, "c") for d, t in TEXTS], "doc_id long, text string, component_id string")
    got = [(r.doc_id, r.text, r.fingerprint, r.component_id) for r in S.classes(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain_classes(TEXTS)))


def test_query_against_brute_force(spark):
    from daybook.llm.registry import queries

    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in queries()["op7_simhash"](spark, sf).collect())
    assert got == sorted((d, f, c) for d, _, f, c in plain_classes(docs))
    assert sum(d != c for d, _, c in got) > 10


def test_empty_table(spark):
    assert S.classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0
