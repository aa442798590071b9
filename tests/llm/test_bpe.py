import hashlib
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from daybook.llm import bpe as B

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", "   \n\t", "Hello World's don't WE'LL it's", "a" * 3000, "x<|endoftext|>y <|startoftext|>", "<|endof", "École über ﬁ ẞ Σίσυφος ΟΔΟΣ",
    "é É", "١٢٣ 12345", "日本語のテキスト 🎉🎉!!", "\x1c\x1d a b　c d\x85e", "İstanbul ǅ", "a.b,c--d__e", "​﻿ zero", "the the the " * 500,
    "\r\n \x0b\x0c mixed\x00null", "#$%&|<> <| |>", "'s's'T'RE",
]


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


def expected(lib, t):
    ids = lib.encode(t or "", add_special_tokens=False).ids
    return ids, lib.decode(ids, skip_special_tokens=False)


def test_like_the_library(spark, lib):
    rnd = random.Random(5)
    alphabet = list("abcdeth ERN'!.1é ß\nœ漢<|>") + ["<|endoftext|>", "ing", "tion "]
    texts = TEXTS + ["".join(rnd.choices(alphabet, k=rnd.randrange(120))) for _ in range(400)]
    rows = B.encode_documents(spark.createDataFrame([(t, 1) for t in texts], "text string, bpe int"), PATH).collect()
    for r in rows:
        ids, decoded = expected(lib, r.text)
        assert (r.bpe.ids, r.bpe.decoded) == (ids, decoded), r.text
        assert r.bpe.n_tokens == len(ids) and r.bpe.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
    assert len(rows) == len(texts)


def test_query_is_whole(spark, lib):
    from daybook.llm.registry import queries

    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries()["op8_bpe"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids, decoded = expected(lib, d.text)
        assert got[d.doc_id].n_tokens == len(ids) and got[d.doc_id].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()


def test_empty_table_and_size_bound(spark, tmp_path):
    assert B.encode_documents(spark.createDataFrame([], "text string"), PATH).count() == 0
    big = tmp_path / "big.json"
    with big.open("wb") as f:
        f.truncate(B.MAX_VOCAB_BYTES + 1)
    with pytest.raises(ValueError):
        B.read_spec(str(big))
