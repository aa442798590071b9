import random

import pytest

from daybook.llm import decontaminate as D


def plain_closest(p, t):
    """Least edit distance of p to a substring of t, by the whole table."""
    col = list(range(len(p) + 1))
    best = col[-1]
    for c in t:
        last, col[0] = col[0], 0
        for i in range(1, len(p) + 1):
            last, col[i] = col[i], min(col[i] + 1, col[i - 1] + 1, last + (p[i - 1] != c))
        best = min(best, col[-1])
    return best


def test_bit_parallel_distance():
    rnd = random.Random(2)
    for _ in range(400):
        p = "".join(rnd.choices("abc ", k=rnd.randrange(1, 90)))
        t = "".join(rnd.choices("abc ", k=rnd.randrange(0, 120)))
        edits, end = D.closest(D.masks(p), len(p), t)
        assert edits == plain_closest(p, t) and plain_closest(p, t[:end]) == edits


def brute(items, text, rate=D.ERROR_RATE):
    t, out = D.normalised(text), set()
    for item_id, item in items:
        p = D.normalised(item)
        if p and len(p) < D.MIN_CHARS:
            if f" {p} " in f" {t} ":
                out.add((item_id, 0))
        elif p and (e := plain_closest(p, t)) <= int(len(p) * rate):
            out.add((item_id, e))
    return out


def corpus():
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choices("abcdefgh", k=rnd.randrange(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(rnd.randrange(8, 30))) for i in range(12)] + [(50, "two words"), (51, ""), (52, None), (None, "Tie, tie; a tie that has no id.")]
    items.append((60, items[0][1].upper()))
    texts = [None, "", "!!!", "two words", "xtwo words", "a tie tie a tie that has no id b", prose(4000), items[3][1][3:]]
    for i in range(60):
        p = list(items[i % 12][1])
        for _ in range(i // 6):
            at = rnd.randrange(len(p))
            p[at : at + 1] = rnd.choice(["", "z", "zz"])
        texts.append(prose(rnd.randrange(0, 40)) + "\n" + "".join(p) + ". " + prose(rnd.randrange(0, 40)))
    return items, texts


@pytest.mark.parametrize("block", [10**6, 150])
def test_finds_exactly_what_all_pairs_find(spark, block):
    items, texts = corpus()
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, leaks int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = D.find_leaks(docs, bench, block_chars=block).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert {(x.item_id, x.edits) for x in r.leaks} == brute(items, r.text), r.text
        for x in r.leaks:
            got = D.normalised(r.text)[x.start : x.stop]
            p = D.normalised(dict(items)[x.item_id])
            assert plain_closest(p, got) == x.edits and x.places >= 1


def test_query_finds_planted_passages(spark):
    from daybook.llm.registry import queries

    sf = "/root/testdata/sf0.01"
    got = {(r.doc_id, r.item_id) for r in queries()["op4_decontaminate"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = [(r.item_id, D.normalised(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    exact = {(d.doc_id, i) for d in docs for i, p in items if p in D.normalised(d.text)}
    assert exact and exact <= got and len(got - exact) <= 0.1 * len(exact)


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([("a b c",)], "text string"), spark.createDataFrame([], "item_id long, text string")
    assert D.find_leaks(docs, bench).first().leaks == []
    assert D.find_leaks(docs.where("false"), bench).count() == 0
