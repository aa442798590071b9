"""Benchmark decontamination by pigeonhole edit matching.

Both sides are normalised: lower case, words (letters, digits, underscore)
joined by one blank. A test item of m characters has an error budget of
k = m * ``ERROR_RATE`` edits and is split into k + 1 pieces: in any passage
within k edits of it, at least one piece stands unchanged. One Aho-Corasick
automaton finds every exact piece hit in one pass over a text; each hit is
verified by Myers' bit-parallel edit distance of the item against the text
around the hit. Nothing is missed and nothing is reported unverified.

Documents are independent: no shuffle. Items are the stated query set: they
are read in blocks of about ``BLOCK_CHARS`` characters, each block's automaton
being broadcast, so the broadcast has a bound whatever the benchmark's size.

Defined results: null, empty and wordless texts and items match nothing. An
item under ``MIN_CHARS`` characters has no budget and must stand as whole
words. Repeated items are reported with each of their ids, null ids included;
repeated documents each have their own report. One report for an item and a
document: the fewest edits, at the first such place, with the number of places
found (overlapping places of one item count once). A very long text is searched whole, in
one pass of the automaton, in the task that reads it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import col, fresh, prepared_session, table

ERROR_RATE, MIN_CHARS, BLOCK_CHARS = 0.08, 20, 4_000_000
LEAK = "array<struct<item_id:long,edits:int,start:long,stop:long,places:int>>"
WORD = re.compile(r"\w+")


def normalised(text: str | None) -> str:
    return " ".join(WORD.findall((text or "").lower()))


def pieces(item: str, parts: int) -> list[tuple[int, str]]:
    """(offset, piece) of ``parts`` pieces of nearly equal length."""
    cuts = [len(item) * i // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def closest(peq: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to any substring of ``text``, and the first end of one (Myers 1999).

    The pattern's column of the dynamic programme is held as two bit vectors of
    m bits, so one step handles a whole column.
    """
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for i, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
        if score < best:
            best, end = score, i + 1
    return best, end


class Matcher:
    """All items of one block."""

    def __init__(self, items: list[tuple[int | None, str]], error_rate: float = ERROR_RATE, min_chars: int = MIN_CHARS):
        by_text: dict[str, list[int | None]] = {}
        for item_id, text in items:
            if norm := normalised(text):
                by_text.setdefault(norm, []).append(item_id)
        self.items = []
        self.found: dict[str, list[tuple[int, int]]] = {}
        for n, (norm, ids) in enumerate(sorted(by_text.items())):
            budget = int(len(norm) * error_rate) if len(norm) >= min_chars else 0
            self.items.append((norm, ids, budget, masks(norm), masks(norm[::-1]), len(norm) < min_chars))
            for offset, piece in pieces(norm, budget + 1):
                self.found.setdefault(piece, []).append((n, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in self.found.items():
            self.automaton.add_word(piece, (len(piece), where))
        if self.found:
            self.automaton.make_automaton()

    def verified(self, text: str, n: int, at: int) -> tuple[int, int, int] | None:
        """(edits, start, stop) of item n near offset ``at`` of the text, within its budget."""
        norm, _, budget, forward, backward, whole = self.items[n]
        m = len(norm)
        lo, hi = max(0, at - budget), at + m + budget
        if at >= 0 and text.startswith(norm, at):
            cut_off = whole and ((at and text[at - 1] != " ") or text[at + m : at + m + 1] not in ("", " "))
            return None if cut_off else (0, at, at + m)
        if budget == 0:
            return None
        edits, end = closest(forward, m, text[lo:hi])
        if edits > budget:
            return None
        stop = lo + end
        _, back = closest(backward, m, text[max(0, stop - m - edits) : stop][::-1])
        return edits, stop - back, stop

    def leaks(self, text: str | None) -> list[tuple]:
        """One (item_id, edits, start, stop, places) for each item found."""
        norm = normalised(text)
        if not norm or not self.found:
            return []
        tried: set[tuple[int, int]] = set()
        good: dict[int, list[tuple[int, int, int]]] = {}
        for end, (length, where) in self.automaton.iter(norm):
            for n, offset in where:
                at = end + 1 - length - offset
                if at < -self.items[n][2] or (n, at) in tried:
                    continue  # more than the budget before the text's start
                tried.add((n, at))
                if (v := self.verified(norm, n, at)) is not None:
                    good.setdefault(n, []).append(v)
        out = []
        for n, places in sorted(good.items()):
            best = min(places)
            count, reach = 0, -1
            for _, start, stop in sorted(places, key=lambda x: x[1]):
                if start >= reach:
                    count += 1
                reach = max(reach, stop)
            out += [(item_id, best[0], best[1], best[2], count) for item_id in self.items[n][1]]
        return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
               error_rate: float = ERROR_RATE, min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Append ``leaks``, an array of reports; a clashing input column is replaced.

    Offsets are characters of the normalised text.
    """
    spark = prepared_session(docs.sparkSession)
    items = benchmark.select(col(item_id).cast("long").alias("item_id"), col(item_text).alias("text")).where("text IS NOT NULL")
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_chars))
    own = [c for c in docs.columns if c.lower() != "leaks"]
    out, made = docs.select(*[col(c) for c in own]), []
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        shared = spark.sparkContext.broadcast([(r.item_id, r.text) for r in block])
        made.append(fresh(out, f"leaks_{b}"))
        out = out.withColumn(made[-1], _search(shared, error_rate, min_chars)(col(text)))
    return out.select(*[col(c) for c in own], F.flatten(F.array(*made)).alias("leaks"))


def _search(shared, error_rate: float, min_chars: int):
    @F.pandas_udf(LEAK)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(shared.value, error_rate, min_chars)
        names = ("item_id", "edits", "start", "stop", "places")
        for part in parts:
            yield pd.Series([[dict(zip(names, x)) for x in matcher.leaks(t)] for t in part], dtype="object")

    return run


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
