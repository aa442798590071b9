import math
import re

from daybook.llm import license_scan as L

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(t, templates=L.TEMPLATES, threshold=L.THRESHOLD):
    w = words(t)
    places = [(i, lab) for p, lab in L.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    step = max(len(words(x)) for _, x in templates)
    labels, share = {lab for _, lab in places}, 0.0
    for lab, x in templates:
        T = set(words(x))
        for b in range(0, len(w), step):
            n = len(T & set(w[b : b + 2 * step]))
            if n >= (len(T) if len(T) < L.SHORT else math.ceil(threshold * len(T) - 1e-9)):
                labels.add(lab)
                share = max(share, n / len(T))
    return (len(w), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None),
            ",".join(sorted({lab for _, lab in places})), ",".join(sorted(labels)), 1.0 if places else share)


FILL = " ".join(f"word{i}" for i in range(70))
TEXTS = [
    None, "", "...", "All rights reserved.", "CC-BY cc by\ncc by!", "ccK by", "cc byé", "x" * 50000,
    f"{FILL} Licensed under the Apache License, Version 2.0. {FILL}", f"{FILL} licensed under apache license version 2",
    "Released under the MIT", "under the MIT License", "the license under mit", "licensed apache under version the",
    "permission granted free of charge to any person obtaining copy of this", f"GNU General Public License {FILL} general public license",
    (FILL + " Licensed under CC BY-NC 4.0. ") * 40, "license " * 500, "É LICENSED UNDER THE APACHE LICENSE VERSION 2 0",
]


def test_against_brute_force(spark):
    rows = [(i if i % 4 else None, t, "x") for i, t in enumerate(TEXTS + TEXTS)]
    got = L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, score string")).collect()
    assert sorted(str((r.text, *[r[c] for c in L.OUTPUTS])) for r in got) == sorted(str((t, *brute(t))) for _, t, _ in rows)


def test_short_templates_need_all_their_words(spark):
    texts = {"Licensed under CC BY 4.0": "cc-by", "Released under the BSD License": "", "under the license agreement I released a statement": "",
             "Released under the MIT License": "mit", "Licensed under CC BY-NC 4.0": "cc-by,cc-by-nc-4.0", "Licensed under the Apache License, Version 1.0": ""}
    got = L.scan_licenses(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    assert {r.text: r.labels for r in got} == texts


def test_query_against_brute_force(spark):
    from daybook.llm.registry import queries

    sf = "/root/testdata/sf0.01"
    q = queries()["op10_license_scan"](spark, sf)
    assert "Python" not in q._jdf.queryExecution().executedPlan().toString()
    got = {r.doc_id: tuple(r[c] for c in L.OUTPUTS) for r in q.collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs) and all(got[d.doc_id] == brute(d.text) for d in docs)
    assert sum(bool(v[5]) for v in got.values()) > 10


def test_empty_inputs(spark):
    assert L.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    one = L.scan_licenses(spark.createDataFrame([("cc by apache license",)], "text string"), templates=[]).first()
    assert (one.labels, one.score) == ("cc-by", 1.0)
