"""Byte-pair encoding and decoding with a queue of merge ranks over a doubly linked symbol list.

A word's symbols are a doubly linked list held in two index arrays. Every
adjacent pair that has a merge goes into a heap as one integer of rank and position;
an entry is stale, and skipped, when the symbols at its position are no longer
the pair of that rank. A merge pushes at most two new pairs, so a word of n symbols costs
O(n log n) whatever its length. Decoding concatenates vocabulary strings.

The vocabulary file is read once on the driver and broadcast; its size is that
of a tokenizer file (checked against ``MAX_VOCAB_BYTES``) and does not grow
with the data. Documents are independent: no shuffle. Words repeat, so each
Python worker keeps the encodings of recent words, at most ``CACHED_WORDS``.

Defined results: a null or blank text has no ids and decodes to the empty
string; repeated rows give equal rows; ties in rank are merged leftmost first;
a symbol that the vocabulary lacks is left out (it has no id). The strings of
special tokens in a text are encoded as those tokens.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import struct
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import col, prepared_session, table

CACHED_WORDS = 400_000
MAX_VOCAB_BYTES = 64 << 20
#: Characters with the property White_Space.
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Bits of a symbol, and of a place in a word.
BITS, PLACE = 24, 40
SYMBOL, PLACES = (1 << BITS) - 1, (1 << PLACE) - 1


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself if printable, else the next free character from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def lower_each(text: str) -> str:
    """Lower-case character by character: without the rule for a sigma at a word's end."""
    return "".join(map(str.lower, text)) if "Σ" in text else text.lower()


class Known(dict):
    """Encoded words, made when first asked for; emptied when full."""

    def __init__(self, make: Callable[[str], tuple[bytes, str]]):
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> tuple[bytes, str]:
        if len(self) >= CACHED_WORDS:
            self.clear()
        got = self.make(word)
        if len(word) <= 64:
            self[word] = got
        return got


class Bpe:
    """Encoder and decoder of one vocabulary file of the ``tokenizers`` format with word ends."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        vocab = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.strings = {i: s for s, i in (vocab | self.special).items()}
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        # both symbols in one key, rank and new symbol in one value
        self.merges = {vocab[a] << BITS | vocab[b]: rank << BITS | vocab[a + b] for rank, (a, b) in enumerate(pairs)}
        steps = data["pre_tokenizer"]["pretokenizers"]
        pattern = steps[0]["pattern"]["Regex"].replace("\\s", SPACES)
        self.words = regex.compile(pattern)
        ascii_ = pattern.replace("\\p{L}", "a-zA-Z").replace("\\p{N}", "0-9")
        self.ascii_words = re.compile(ascii_) if "\\p" not in ascii_ else self.words
        # white space that no word can hold needs no joining: it only separates
        self.blanks = regex.compile(f"[{SPACES}]+") if " " in steps[0]["pattern"]["Regex"] or self.words.search(WHITE) else None
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        alphabet = byte_alphabet()
        self.inner = [vocab.get(c) for c in alphabet]
        self.last = [vocab.get(c + self.suffix) for c in alphabet]
        self.cache = Known(self.known)

    def merge(self, symbols: list[int]) -> list[int]:
        n, find = len(symbols), self.merges.get
        queue = [m >> BITS << PLACE | i for i in range(n - 1) if (m := find(symbols[i] << BITS | symbols[i + 1]))]
        if not queue:
            return symbols
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            i = entry & PLACES
            j = after[i]
            if j < 0 or symbols[i] < 0:
                continue
            m = find(symbols[i] << BITS | symbols[j])
            if m is None or m >> BITS != entry >> PLACE:
                continue  # stale: one of the two was merged away
            symbols[i] = new = m & SYMBOL
            symbols[j] = -1
            after[i] = right = after[j]
            if right >= 0:
                before[right] = i
                if m := find(new << BITS | symbols[right]):
                    heapq.heappush(queue, m >> BITS << PLACE | i)
            left = before[i]
            if left >= 0 and (m := find(symbols[left] << BITS | new)):
                heapq.heappush(queue, m >> BITS << PLACE | left)
        return [s for s in symbols if s >= 0]

    def encode_word(self, word: str) -> list[int]:
        raw = word.encode("utf-8", "surrogatepass")
        symbols = [*map(self.inner.__getitem__, raw[:-1]), self.last[raw[-1]]]
        return self.merge([s for s in symbols if s is not None])

    def known(self, word: str) -> tuple[bytes, str]:
        """A word's ids as little-endian 32-bit integers, and its decoded string."""
        ids = self.encode_word(word)
        return struct.pack(f"<{len(ids)}I", *ids), self.decode(ids)

    def pieces(self, text: str) -> list[tuple[bytes, str]]:
        parts = self.cut.split(text) if self.cut and any(s in text for s in self.special) else [text]
        found = []
        for part in parts:
            if part in self.special:
                found.append((struct.pack("<I", self.special[part]), part))
            elif part:
                plain = part if part.isascii() else unicodedata.normalize("NFC", part)
                plain = lower_each(self.blanks.sub(" ", plain) if self.blanks else plain)
                found += map(self.cache.__getitem__, (self.ascii_words if plain.isascii() else self.words).findall(plain))
        return found

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings in order, one space between them (the file names no decoder)."""
        return " ".join(s for i in ids if (s := self.strings.get(i)) is not None)

    def encode(self, text: str | None) -> tuple[bytes, str]:
        """Ids of a text as little-endian 32-bit integers, and their decoded string."""
        found = self.pieces(text or "")
        return b"".join([x[0] for x in found]), " ".join([x[1] for x in found if x[0]])


def read_spec(path: str) -> str:
    """The vocabulary file, read on the driver; larger than a tokenizer file is an error."""
    if (size := os.path.getsize(path)) > MAX_VOCAB_BYTES:
        raise ValueError(f"{path} has {size} bytes; a vocabulary of at most {MAX_VOCAB_BYTES} is broadcast")
    with open(path, encoding="utf-8") as f:
        return f.read()


_LOADED: dict[str, Bpe] = {}


def _bpe(spec: str) -> Bpe:
    """One encoder a Python worker, kept over tasks."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Bpe(spec)
    return _LOADED[key]


#: What ``encode_documents`` returns beside the count and the digests.
SHAPES = {"digests": "", "bytes": ", ids binary", "lists": ", ids array<int>, decoded string"}


def encode_documents(docs: DataFrame, path: str, text: str = "text", shape: str = "lists") -> DataFrame:
    """Append a struct column ``bpe``: n_tokens, ids_sha256, decoded_sha256 and what ``shape`` names.

    ``path`` is the vocabulary file. ``lists``: ids and the decoded text;
    ``bytes``: ids as little-endian unsigned 32-bit integers; ``digests``:
    neither leaves the task. A clashing input column ``bpe`` is replaced.
    """
    spark = prepared_session(docs.sparkSession)
    shared = spark.sparkContext.broadcast(read_spec(path))
    kind = "n_tokens long, ids_sha256 string, decoded_sha256 string" + SHAPES[shape]
    names = [c.split(" ")[0] for c in kind.split(", ")]

    @F.pandas_udf(kind)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = _bpe(shared.value)
        for part in parts:
            rows = []
            for t in part:
                ids, decoded = bpe.encode(t)
                n = len(ids) // 4
                more = (ids,) if shape == "bytes" else (list(struct.unpack(f"<{n}I", ids)), decoded) if shape == "lists" else ()
                rows.append((n, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest(), *more))
            yield pd.DataFrame(rows, columns=names)

    others = [c for c in docs.columns if c.lower() != "bpe"]
    return docs.select(*[col(c) for c in others], run(col(text)).alias("bpe"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), shape="digests")
    return out.select("doc_id", "bpe.n_tokens", "bpe.ids_sha256", "bpe.decoded_sha256")
