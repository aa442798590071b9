"""Language ID by rank-order profiles and out-of-place distance.

A profile is the most frequent character n-grams (1 to 3 characters, inside
words, a blank marking a word's ends), by descending count. A language's
profile counts all documents that teach it; a document's profile counts its
whole text. The out-of-place distance adds up, over the document's n-grams,
how far each one's rank is from its rank in the language's profile, or
``RANKS`` where the language lacks it. The least distance wins.

Tasks count n-grams with numpy and send (language, n-gram, count) sums only:
as many rows as a language has n-grams, not as many as it has documents. The
profiles, ``RANKS`` n-grams a language, come to the driver and are broadcast;
``MAX_LANGUAGES`` bounds them.

Defined results: a null text, or one without a letter, has language ``und``
and score 0. Ties in count go to the smaller n-gram, ties in distance to the
first language by name. Documents with a null language or text, or a null id,
teach nothing; a null id is not held out. Repeated rows teach each
time and get equal answers. A very long text is counted whole, in pieces of
``CHUNK`` characters. Nothing to learn from: every document is ``und``. Score: 1 less the distance as a part of the largest one.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.llm.common import col, fresh, prepared_session, table

RANKS, MAX_LANGUAGES = 400, 1000
UNKNOWN = "und"
CHUNK = 1 << 20


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point: is it a letter, or a mark as belongs to one?"""
    return np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(sys.maxunicode + 1)])


def letter_runs(text: str) -> np.ndarray:
    """Code points of the lower-cased letters; a 1 for each run of others, and at both ends. Empty without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
    if not any(map(str.isalpha, text)):
        return np.empty(0, np.int64)
    is_letter = letters()[points]
    runs = np.where(is_letter, points, 1)
    runs = np.concatenate(([1], runs, [1]))
    kept = np.concatenate(([True], (runs[1:] != 1) | (runs[:-1] != 1)))
    return runs[kept]


def grams(runs: np.ndarray) -> np.ndarray:
    """One integer for each n-gram: 21 bits a character, so lengths can't collide."""
    a, b, c = runs[:-2], runs[1:-1], runs[2:]
    one = runs[runs != 1]
    two = (runs[:-1] << 21) | runs[1:]
    three = ((a << 42) | (b << 21) | c)[b != 1]
    return np.concatenate((one, two, three))


def counted(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text and their counts, in pieces of bounded size."""
    if len(runs) <= CHUNK:
        return np.unique(grams(runs), return_counts=True)
    parts = [np.unique(grams(runs[i : i + CHUNK + 2]), return_counts=True) for i in range(0, len(runs) - 2, CHUNK)]
    # pieces share two characters: what starts there was counted twice
    over = [grams(runs[i : i + 2]) if len(runs[i : i + 2]) > 2 else _short(runs[i : i + 2]) for i in range(CHUNK, len(runs) - 2, CHUNK)]
    codes = np.concatenate([p[0] for p in parts] + over)
    counts = np.concatenate([p[1] for p in parts] + [np.full(len(o), -1) for o in over])
    codes, counts = summed(codes, counts)
    return codes[counts > 0], counts[counts > 0]


def _short(runs: np.ndarray) -> np.ndarray:
    """n-grams wholly inside two characters."""
    return np.concatenate((runs[runs != 1], (runs[:-1] << 21) | runs[1:]))


def summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(codes, return_inverse=True)
    return distinct, np.bincount(at, weights=counts, minlength=len(distinct)).astype(np.int64)


def top(codes: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` most frequent n-grams in order; codes must be ascending, so equal counts keep that order."""
    return codes[np.argsort(-counts, kind="stable")[:n]]


def taught_by(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 5: 0 is held out; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", ranks: int = RANKS) -> list[tuple[str, np.ndarray]]:
    """Profiles of all languages of ``docs``, by name."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, part in batch.groupby("lang"):
                codes, counts, held = [], [], 0
                for t in part["text"]:
                    if len(runs := letter_runs(t)):
                        got = counted(runs)
                        codes.append(got[0])
                        counts.append(got[1])
                        held += len(got[0])
                        if held > CHUNK:
                            got = summed(np.concatenate(codes), np.concatenate(counts))
                            codes, counts, held = [got[0]], [got[1]], 0
                if codes:
                    got = summed(np.concatenate(codes), np.concatenate(counts))
                    yield pd.DataFrame({"lang": name, "gram": got[0], "n": got[1]})

    prepared_session(docs.sparkSession)
    taught = docs.select(col(text).alias("text"), col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    sums = taught.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    rows = sums.withColumn("place", place).where(F.col("place") <= ranks).limit(MAX_LANGUAGES * ranks + 1).collect()
    if len(rows) > MAX_LANGUAGES * ranks:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    profiles: dict[str, list[int]] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.place)):
        profiles.setdefault(r.lang, []).append(r.gram)
    return [(k, np.array(v, np.int64)) for k, v in profiles.items()]


def identify(docs: DataFrame, profiles: list[tuple[str, np.ndarray]], text: str = "text", ranks: int = RANKS) -> DataFrame:
    """Append ``lang_pred`` and ``score``; clashing input columns are replaced."""
    spark = prepared_session(docs.sparkSession)
    names = [k for k, _ in profiles]
    # each profile sorted by n-gram, with the rank of each
    sorted_ = [(v[o := np.argsort(v)], o) for _, v in profiles]
    shared = spark.sparkContext.broadcast((names, sorted_))

    @F.pandas_udf("lang_pred string, score double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names, sorted_ = shared.value
        for part in parts:
            out = []
            for t in part:
                runs = letter_runs(t) if t else np.empty(0, np.int64)
                if not len(runs) or not names:
                    out.append((UNKNOWN, 0.0))
                    continue
                own = top(*counted(runs), ranks)
                here = np.arange(len(own))
                far = []
                for codes, place in sorted_:
                    at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
                    far.append(int(np.where(codes[at] == own, np.abs(place[at] - here), ranks).sum()))
                best = int(np.argmin(far))
                out.append((names[best], 1.0 - far[best] / (ranks * len(own))))
            yield pd.DataFrame(out, columns=["lang_pred", "score"])

    own = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    name = fresh(docs, "lang_id")
    out = docs.select(*[col(c) for c in own], predict(col(text)).alias(name))
    return out.select(*[col(c) for c in own], f"{name}.lang_pred", f"{name}.score")


def identified(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``identify`` with profiles learned from the documents of ``docs`` that are not held out."""
    return identify(docs, fit(docs.where(taught_by(col(doc_id)) != 0), text, lang), text)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = identified(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    held_out = F.coalesce(taught_by(F.col("doc_id")) == 0, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
