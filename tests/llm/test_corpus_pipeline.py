import hashlib
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from daybook.llm.decontaminate import normalised
from test_quality_rules import base
from test_simhash import plain_classes

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    """Rows before the first stage and after each."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for k, (_, stage) in enumerate(P.STAGES):
        docs = P.staged(stage(spark, docs, SF), f"test-{k}")
        if k < len(P.STAGES) - 1:
            assert docs.columns == spark.read.parquet(f"{SF}/documents.parquet").columns
        out.append(docs.collect())
    return out


def test_quality_stage(spark, steps):
    kept = {r.doc_id for r in steps[1]}
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rest = [r for r in steps[0] if not base(r.text)[5]]
    assert kept <= {r.doc_id for r in rest}
    assert all(r.doc_id in kept for r in rest if label.get(r.doc_id) == 1)
    assert not any(r.doc_id in kept for r in rest if label.get(r.doc_id) == 0)


def test_language_stage_keeps_what_has_letters(steps):
    assert sorted(steps[2]) == sorted(r for r in steps[1] if any(c.isalpha() for c in r.text))


def test_near_copies_stage(steps):
    firsts = {c for _, _, _, c in plain_classes([(r.doc_id, r.text) for r in steps[2]])}
    assert sorted(steps[3]) == sorted(r for r in steps[2] if r.doc_id in firsts) and len(steps[3]) < len(steps[2])


def test_passages_stage(spark, steps):
    items = [normalised(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in steps[3] if not any(i in normalised(r.text) for i in items)}
    assert {r.doc_id for r in steps[4]} == clean and len(clean) < len(steps[3])


def test_encoding_stage_and_run(spark, steps):
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    text = {r.doc_id: r.text for r in steps[4]}
    for r in steps[5]:
        ids = lib.encode(text[r.doc_id], add_special_tokens=False).ids
        assert bytes(r.ids) == struct.pack(f"<{len(ids)}I", *ids) and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert sorted(map(str, P.run(spark, SF).collect())) == sorted(map(str, steps[5]))


def test_odd_rows_run_through(spark, tmp_path):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "a b " * 100, None, None, None), (1, "", "en", "s", 0), (None, "word " * 9, "en", "s", 9)]
    rows += [(10 + i % 3, " ".join("tok" + "".join("abcdefghij"[int(x)] for x in str(j * (i % 3 + 1))) for j in range(90)), "en", "s", 1) for i in range(6)]
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(*r, 1, "x", None, "row", 2, 3) for r in rows]
    clash = "kept int, lang_pred string, leaks string, row string, fingerprint int, bpe int"
    spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {clash}").write.parquet(f"{tmp_path}/documents.parquet")
    first = P.staged(P.keep_good(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)), "clash")
    for stage in (P.keep_known_language, P.keep_one_of_near_copies, P.drop_benchmark_passages):
        first = stage(spark, first, str(tmp_path))
    assert {tuple(r)[5:] for r in first.collect()} == {(1, "x", None, "row", 2, 3)}
    assert sorted(r.doc_id for r in P.run(spark, str(tmp_path)).collect()) == [10, 11, 12]
