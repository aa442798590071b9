import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import suffix_dedup as S

SF = "/root/testdata/sf0.01"
L = S.LENGTH


def plain(rows):
    """(id, n_bytes, n_removed, n_spans, digest) from the definition."""
    least = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        if i is not None:
            for k in range(len(b) - L + 1):
                w = b[k : k + L]
                if w not in least or least[w] > i:
                    least[w] = i
    out = []
    for i, b in data:
        gone = np.zeros(len(b) + 1, bool)
        if i is not None:
            for k in range(len(b) - L + 1):
                if least[b[k : k + L]] < i:
                    gone[k : k + L] = True
        spans = int((gone & ~np.append(False, gone[:-1])).sum())
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def key(x):
    return (x[0] is not None, x[0] or 0, x[1:])


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    df = df.withColumns({"kept": F.lit(1), "Removed": F.lit("x"), "tag": F.lit(2), "start": F.lit("y"), "row": F.lit(0)})
    got = S.deduplicate(df, **kw)
    assert got.columns == ["doc_id", "text", "tag", "start", "row", "kept", "removed"]
    out = []
    for r in got.collect():
        data, at, kept = (r.text or "").encode(), 0, b""
        for s in r.removed:
            assert at <= s.start < s.stop
            kept, at = kept + data[at : s.start], s.stop
        assert bytes(r.kept) == kept + data[at:]
        out.append((r.doc_id, len(data), sum(s.stop - s.start for s in r.removed), len(r.removed), hashlib.sha256(r.kept).hexdigest()))
    return sorted(out, key=key)


def corpus(n, seed=5):
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choices("abcdeé日 ", k=rnd.randrange(1, 9))) for _ in range(300)]
    make = lambda k: " ".join(rnd.choices(vocab, k=k))
    shared = [make(rnd.randrange(5, 40)) for _ in range(12)] + ["=" * 70, "ab" * 60, "a" * 49]
    rows = []
    for i in range(n):
        parts = [make(rnd.randrange(0, 25)) for _ in range(rnd.randrange(0, 4))] + rnd.choices(shared, k=rnd.randrange(0, 3))
        rnd.shuffle(parts)
        rows.append((rnd.randrange(-5, 10**6), "\n".join(parts)))
    rows += [(10**7 + i, t) for i, t in rnd.sample(rows, n // 4)]
    rows += [(rows[0][0], make(30) + shared[0]), rows[1], rows[2], (None, shared[1] * 2), (None, rows[3][1]), (3, None), (4, "")]
    return rows


@pytest.mark.parametrize("kw", [{}, {"shard_bytes": 500, "fan": 4}])
def test_against_the_definition(spark, kw):
    rows = corpus(120)
    assert run(spark, rows, **kw) == sorted(plain(rows), key=key)


def test_unique_ids_hot_anchor_and_runs(spark, monkeypatch):
    rnd = random.Random(1)
    line = "this very common line stands in every text, with other words around it"
    word = lambda: "".join(rnd.choices("abcdefgh", k=12))
    rows = [(i, f"{word()} {word()} {line} {word()} {word()} {line[:52]}{word()}") for i in range(300)]
    rows += [(1000, "z" * 400), (1001, "y" + "z" * 200), (1002, "z" * 49), (1003, "z" * 50)]
    want = sorted(plain(rows), key=key)
    assert run(spark, rows) == want
    monkeypatch.setattr(S, "HOT", 0)
    assert run(spark, rows, shard_bytes=2000, fan=3) == want


def test_long_text_in_chunks(spark, monkeypatch):
    rnd = random.Random(2)
    text = "".join(rnd.choices("abcdefghij ", k=30_000))
    rows = [(1, text), (2, text[5000:9000] + "#" + text[100:20_000]), (3, "-" + text[:60] + "-")]
    monkeypatch.setattr(S, "CHUNK", 1000)
    monkeypatch.setattr(S, "BATCH", 3000)
    assert list(np.concatenate([h.all()[0] for h in S.batches_of(iter([_batch(rows)]))])) != []
    assert run(spark, rows) == sorted(plain(rows), key=key)


def _batch(rows):
    import pyarrow as pa

    return pa.RecordBatch.from_pydict({"doc_id": [r[0] for r in rows], "tag": [0] * len(rows), "text": [r[1] for r in rows]})


def test_many_shards_are_moved_once(spark):
    """More shards than the keys of one exchange: several share a key, so that no text is moved a second time."""
    rows = corpus(120)
    docs = spark.createDataFrame([(i, 0, t or "") for i, t in rows if i is not None], "doc_id long, tag long, text string")
    plan = S.spans_of(docs, shard_bytes=4)._jdf.queryExecution().optimizedPlan().toString()
    assert docs.selectExpr("sum(octet_length(text))").first()[0] / 4 > 2 * 1024
    assert plan.count("FlatMapGroupsInArrow") == 1
    assert run(spark, rows, shard_bytes=4) == sorted(plain(rows), key=key)


def test_parts_of_a_piece_are_its_shards():
    rnd = random.Random(3)
    texts = [np.frombuffer("".join(rnd.choices("abcdefgh ", k=900)).encode(), np.uint8) for _ in range(4)]
    held, none = S.Segments(), np.empty(0, np.int64)
    held.cut([*texts, texts[0]], [5, 6, 7, 8, 5], [0] * 5, [0, 0, 0, 0, 1000])
    ids, _, begin, start, size, offset, text = held.all()
    shard, strings = S.shard_of(text, start, offset, 40), lambda i, b, s, n, t: (int(i), int(b), bytes(t[s : s + n]))
    want = {k: sorted(strings(*r, text) for r in zip(*(c[shard == k] for c in (ids, begin, start, size)))) for k in range(40)}
    got = {k: [] for k in range(40)}
    for key_, _, piece in S.sent(held, 0, 40, 7, none):
        columns = S.opened(S.pa.py_buffer(piece))
        assert len(columns) == 8
        for k, part in enumerate(S.parts(columns)):
            of = S.Segments()
            of.arrive(*part)
            i, _, b, s, n, _, t = of.all()
            got.setdefault(7 * key_ + k, []).extend(strings(*r, t) for r in zip(i, b, s, n))
    assert {k: sorted(v) for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, "short"), (2, None)]) == sorted(plain([(1, "short"), (2, None)]), key=key)


def test_intervals_end_where_fewer_bytes_are_shared():
    rnd = random.Random(7)
    parts = ["".join(rnd.choices("ab", k=rnd.randrange(50, 70))) for _ in range(60)]
    parts += [p[rnd.randrange(0, 10) :] + "b" for p in parts[:30]]
    whole = np.frombuffer("\0".join([*parts, ""]).encode(), np.uint8).astype(np.uint16)
    ends = np.repeat(np.flatnonzero(whole == 0), [len(p) + 1 for p in parts])
    order = S.suffix_order(whole, ends)
    label = S.intervals(whole, order)
    suffix = [bytes(whole[i : ends[i]].astype(np.uint8)) for i in order]
    for k in range(1, len(order)):
        a, b = suffix[k - 1], suffix[k]
        assert a[:L] <= b[:L]
        if len(a) >= L and len(b) >= L:
            assert (label[k] == label[k - 1]) == (a[:L] == b[:L])


def test_anchor_is_that_of_the_string_alone():
    rnd = random.Random(8)
    text = np.array([rnd.randrange(97, 100) for _ in range(500)] + [0] * 8, np.uint8)
    place = S.anchors(text)
    assert len(place) == 500 - L + 1
    for k in (0, 1, 77, 200, 450):
        alone = np.append(text[k : k + L], np.zeros(8, np.uint8))
        assert S.anchors(alone)[0] + k == place[k]


def test_query(spark):
    from daybook.llm.registry import queries

    got = [tuple(r) for r in queries()["op13_suffix_dedup"](spark, SF).collect()]
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = plain(rows)
    assert sorted(got) == sorted(want) and sum(r[2] for r in want) > 10_000


def test_order_of_equal_suffixes_is_free():
    rnd = random.Random(9)
    parts = rnd.choices(["ab" * 40, "a" * 90, "b" * 30 + "a" * 40, *("".join(rnd.choices("ab", k=60)) for _ in range(5))], k=40)
    whole = np.frombuffer("\0".join([*parts, ""]).encode(), np.uint8).astype(np.uint16)
    ends = np.repeat(np.flatnonzero(whole == 0), [len(p) + 1 for p in parts])
    order = S.suffix_order(whole, ends)
    prefix = [bytes(whole[i : min(i + L, ends[i])].astype(np.uint8)) for i in order]
    assert prefix == sorted(prefix)
    label = S.intervals(whole, order)
    for _ in range(5):
        key = {p: k for k, p in enumerate(sorted(set(prefix)))}
        other = np.array([i for _, _, i in sorted((key[p], rnd.random(), int(i)) for p, i in zip(prefix, order))], np.int32)
        assert (other != order).any() and (S.intervals(whole, other) == label).all()
