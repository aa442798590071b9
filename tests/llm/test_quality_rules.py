import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from daybook.llm import quality_rules as Q


def base(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, hit = Counter(zip(w, w[1:], w[2:])), set()
    for i, x in enumerate(zip(w, w[1:], w[2:])):
        if seen[x] > 1:
            hit |= {i, i + 1, i + 2}
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(hit), failed


TEXTS = [None, "", " \n\t ", "a", "a b c", "a a a", "a a a a", "a b c a b c", "x\n\nx\n x\nx \n", "ab c a bc ab c", "a b c d e " * 40,
         "é ß 漢 🎉 #*$%&|<>", "one two three one two three four\x0bfive\x0csix\r\n", "w " * 30000, " ".join(f"w{i}" for i in range(60000))]


def test_statistics_against_brute_force(spark):
    rows = [(i if i else None, t, 7) for i, t in enumerate(TEXTS + TEXTS)]
    got = Q.judge_quality(spark.createDataFrame(rows, "doc_id long, text string, n_words int")).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted(str((r.text, *[r[n] for n in names])) for r in got) == sorted(str((t, *base(t))) for _, t, _ in rows)
    assert all(not r.kept for r in got if r.base_failed)


def test_estimates_recover_accuracies(spark):
    df = spark.sql("""
      SELECT id, id % 10 < 7 AS good, transform(sequence(0, 4), i ->
        CASE WHEN (abs(xxhash64(id, i, 'a')) % 100) < 20 THEN 0
             WHEN ((abs(xxhash64(id, i, 'b')) % 100) < 98) = (id % 10 < 7) THEN 1 ELSE -1 END) AS v FROM range(20000)""")
    prior, acc = Q.estimate(df.groupBy("v").agg(F.count("*").alias("n")), 5)
    assert prior == pytest.approx(0.7, abs=0.02) and all(a == pytest.approx(0.98, abs=0.01) for pair in acc for a in pair)
    right = df.where((Q.posterior(F.col("v"), prior, acc) >= 0.5) == F.col("good")).count()
    assert right > 0.99 * 20000


def test_query_matches_labels_and_base(spark):
    from daybook.llm.registry import queries

    sf = "/root/testdata/sf0.01"
    got = queries()["op3_quality_rules"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = got.join(docs, "doc_id").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "left").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(r.text)
    long = [r for r in rows if r.quality is not None and not r.base_failed]
    assert sum(r.kept for r in long if r.quality == 1) >= 0.99 * sum(r.quality == 1 for r in long)
    assert sum(not r.kept for r in long if r.quality == 0) >= 0.9 * sum(r.quality == 0 for r in long)


def test_empty_table_and_plan(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    out = Q.judge_quality(empty)
    assert out.count() == 0
    plan = empty.select(Q.text_statistics(F.col("text")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_repeats_are_words_not_hashes(spark):
    """With all but a few bits of the hash cut off, as in a text of many millions of words, unequal windows stay apart."""
    from pyspark.sql import functions as F

    rows = [" ".join(f"w{i}" for i in range(400)), "a b c d " * 50 + " ".join(f"v{i}" for i in range(300)) + " a b c", "x y z", "x y z x y z", ""]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(rows)], "k long, text string")
    for bits in (60, 55, 40):
        got = {r.k: r.n for r in df.select("k", Q.repeated_words(Q.words(F.col("text")), F.lit(bits)).alias("n")).collect()}
        assert got == {k: base(t)[4] for k, t in enumerate(rows)}
