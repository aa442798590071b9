"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model predicts a text's characters, in classes: capitals are one class,
decimal digits another, every other character of the trusted text is one of
its own, whatever its script, and those never seen there are one. Counts come from all
trusted documents (labelled good and not toxic). Continuation counts, discounts and
interpolated probabilities are grouped counts and joins of tables sharded by
n-gram. N-grams of the 64 most frequent classes are one dense table of 64 ** 4
log-probabilities (64 MB), one look-up a character; where an n-gram has another
class, its probability comes from sorted tables of all seen n-grams and contexts,
the same model exactly. The seen n-grams come to the driver as Arrow columns and are broadcast,
and each worker fills its dense
table from them, the driver none; the sorted tables have at most
``ORDER`` rows a distinct n-gram of the trusted text, and none if 64 classes are all.

Scores, means and thresholds cover all documents: a document is kept if its
perplexity is not above its language's threshold, the ``QUANTILE`` of that
language's trusted documents, each judged by a model that has not seen it: the
two halves of the trusted text by one counted on the other half. So
trusted text that nobody labelled is kept as often. Short texts say little, so ``SHRINK`` characters
at the mean log-probability of the language's trusted text are added.

Defined results: null and empty texts have no perplexity and are not kept. A
null language is a language of its own. A language without trusted documents
uses the threshold of all trusted ones together. Without any trusted document
there is no perplexity and every non-empty document is kept. A single trusted
document is judged by its own model. Perplexity equal to the threshold keeps. A very long text is scored
whole, piece by piece. Repeated rows are scored each; a repeated label counts
once, and an id is trusted if one of its labels says so.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import col, prepared_session, staged, table

ORDER, BITS, QUANTILE, SHRINK = 4, 6, 0.998, 100
WIDE = 21  # bits of any class: three fit a long
CAPITAL, DIGIT, OTHER, START = 0, 1, 2, 3
FIRST = 4  # classes from here on are single characters
PIECE = 1 << 20
MAX_LANGUAGES = 10_000
#: Bits of the bitmap that rows are looked up in: for each id, at most (16 MB), and in one row of it, as ``bitmap_construct_agg`` makes it.
ID_BITS, MOST_BITS, BUCKET = 16, 1 << 27, 1 << 15
#: So many ids that the bitmap lets through by mistake are broadcast.
MOST_OTHERS = 1 << 20


def class_of(frequent: list[int]) -> np.ndarray:
    """Class of each code point."""
    out = np.full(0x110000, OTHER, np.int32)
    out[[c for c in range(0x110000) if unicodedata.category(chr(c)) == "Lu"]] = CAPITAL
    out[[c for c in range(0x110000) if unicodedata.category(chr(c)) == "Nd"]] = DIGIT
    for i, c in enumerate(frequent):
        out[c] = FIRST + i
    return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)


def ngram_codes(classes: np.ndarray, order: int = ORDER) -> np.ndarray:
    """One integer for each character: its class in the low bits, the classes before it above. Classes are under 64."""
    padded = np.concatenate((np.full(order - 1, START, np.int32), classes.astype(np.int32)))
    n = len(classes)
    out = np.zeros(n, np.int32)
    for k in range(order):
        out = (out << BITS) | padded[k : k + n]
    return out


def contexts_of(classes: np.ndarray, order: int = ORDER) -> np.ndarray:
    """One long for each character: the ``order`` - 1 classes before it, ``WIDE`` bits each."""
    padded = np.concatenate((np.full(order - 1, START, np.int64), classes.astype(np.int64)))
    out = np.zeros(len(classes), np.int64)
    for k in range(order - 1):
        out = (out << WIDE) | padded[k : k + len(classes)]
    return out


def last(context: np.ndarray, k: int) -> np.ndarray:
    """The last ``k`` classes of contexts."""
    return context & ((1 << (WIDE * k)) - 1)


def narrow(context: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Contexts of ``k`` classes in ``BITS`` bits each, and where all of them fit."""
    out, fits = np.zeros(len(context), np.int64), np.ones(len(context), bool)
    for i in range(k):
        one = (context >> (WIDE * i)) & ((1 << WIDE) - 1)
        fits &= one < 1 << BITS
        out |= one << (BITS * i)
    return out, fits


def columns(df: DataFrame) -> list[np.ndarray]:
    """The columns of ``df``, of numbers without nulls, on the driver: 8 or 4 bytes a value, no Python object for each."""
    return [c.to_numpy() for c in df.toArrow().columns]


def frequent_characters(texts: DataFrame) -> list[int]:
    """The characters that are neither capitals nor digits, most frequent first."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(0x110000, np.int64)
        for batch in batches:
            for t in batch["text"]:
                points = code_points(t)
                n[: int(points.max(initial=0)) + 1] += np.bincount(points)
        seen = np.flatnonzero(n)
        yield pd.DataFrame({"c": seen, "n": n[seen]})

    # one row a distinct character comes back
    found, _ = columns(texts.mapInPandas(count, "c long, n long").groupBy("c").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "c"))
    return [c for c in found.tolist() if unicodedata.category(chr(c)) not in ("Lu", "Nd")]


def counted(texts: DataFrame, classes: np.ndarray, order: int) -> DataFrame:
    """(context, symbol, c): n-gram counts of the trusted text, sharded by n-gram."""
    shared = texts.sparkSession.sparkContext.broadcast(classes)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for t in batch["text"]:
                symbol = shared.value[code_points(t)].astype(np.int64)
                held.append((contexts_of(symbol, order), symbol))
                size += len(symbol)
                if size >= PIECE:
                    yield distinct(held)
                    held, size = [], 0
        if held:
            yield distinct(held)

    def distinct(held: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
        context, symbol = (np.concatenate(c) for c in zip(*held))
        at = np.lexsort((symbol, context))
        symbol, context = symbol[at], context[at]
        new = np.flatnonzero(np.concatenate(([True], (symbol[1:] != symbol[:-1]) | (context[1:] != context[:-1]))))
        return pd.DataFrame({"context": context[new], "symbol": symbol[new], "c": np.diff(np.append(new, len(symbol)))})

    return texts.mapInPandas(count, "context long, symbol long, c long").groupBy("context", "symbol").agg(F.sum("c").alias("c"))


def discounts(counts: DataFrame) -> list[float]:
    """D1, D2, D3+ of modified Kneser-Ney; 0.5, 1 and 1.5 where counts of counts are missing."""
    row = counts.agg(*[F.sum(F.when(F.col("c") == k, 1).otherwise(0)) for k in (1, 2, 3, 4)]).first()
    n = [x or 0 for x in row]
    if 0 in n:
        return [0.5, 1.0, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    raw = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return [d if 0 < d < k else 0.5 * k for k, d in zip((1, 2, 3), raw)]


def probabilities(counts: DataFrame, order: int, vocabulary: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """For each order from 1: seen n-grams (context, symbol, p) interpolated down to the uniform, and contexts (context, g).

    ``g`` is the weight a context gives to the order below. The highest order
    has counts, those below the number of distinct characters before them.
    """
    levels = [counts]
    for k in range(order - 1, 0, -1):
        below = levels[-1].groupBy(F.col("context").bitwiseAND((1 << (WIDE * (k - 1))) - 1).alias("context"), "symbol").agg(F.count("*").alias("c"))
        levels.append(staged(below, f"ngrams-{k}"))
    grams, contexts, lower = [], [], None
    for k, level in enumerate(reversed(levels), start=1):
        d1, d2, d3 = discounts(level)
        cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        marked = level.withColumn("cut", cut)
        sums = marked.groupBy("context").agg(F.sum("c").alias("total"), F.sum("cut").alias("mass"))
        own = marked.join(sums, "context").select("context", "symbol", ((F.col("c") - F.col("cut")) / F.col("total")).alias("own"), (F.col("mass") / F.col("total")).alias("g"))
        if lower is None:
            p = own.select("context", "symbol", (F.col("own") + F.col("g") / vocabulary).alias("p"))
        else:
            under = own.withColumn("short", F.col("context").bitwiseAND((1 << (WIDE * (k - 2))) - 1))
            p = under.join(lower.select(F.col("context").alias("short"), "symbol", F.col("p").alias("q")), ["short", "symbol"]).select("context", "symbol", (F.col("own") + F.col("g") * F.col("q")).alias("p"))
        lower = staged(p, f"kneser-ney-{k}")
        grams.append(lower)
        contexts.append(sums.select("context", (F.col("mass") / F.col("total")).alias("g")))
    return grams, contexts


class Table:
    """log P of n-grams: dense by ``ngram_codes`` for classes under 64, from sorted tables for any."""

    def __init__(self, grams: list[DataFrame], contexts: list[DataFrame], vocabulary: int, symbols: int):
        """Each order of the dense part is filled from the one below, then the seen ones set.

        A row of it is a context; the order below has the row of that context
        without its first character.
        """
        size = 1 << BITS
        self.order, self.vocabulary, self.levels, self.seen = len(grams), vocabulary, [], []
        for k, (seen, weights) in enumerate(zip(grams, contexts)):
            of, weight = columns(weights.select("context", F.col("g").cast("float")))
            at = np.argsort(of)
            of, weight = of[at], weight[at]
            context, symbol, p = columns(seen.select("context", "symbol", F.col("p").cast("float")))
            code, fits = narrow(of, k)
            row, found = narrow(context, k)
            found &= symbol < size
            self.seen.append((code[fits].astype(np.int32), weight[fits], (row << BITS | symbol)[found].astype(np.int32), p[found]))
            if symbols > size:
                key = np.searchsorted(of, context) << WIDE | symbol
                at = np.argsort(key)
                self.levels.append((of, weight, key[at], p[at]))

    @cached_property
    def dense(self) -> np.ndarray:
        """Filled where texts are scored: 64 MB in a worker, and none on the driver, which only sends the model."""
        level = np.full((1, 1 << BITS), 1.0 / self.vocabulary, np.float32)
        for k, (of, weight, at, p) in enumerate(self.seen):
            g = np.ones((1 << BITS) ** k, np.float32)
            g[of] = weight
            level = level[np.arange(len(g)) % len(level)]
            level *= g[:, None]
            level.reshape(-1)[at] = p
        level = level.reshape(-1)
        return np.log(level, out=level)

    def __getstate__(self) -> dict:
        """What is sent: the seen n-grams, of which the dense part is filled again."""
        return {k: v for k, v in self.__dict__.items() if k != "dense"}

    def __getitem__(self, code):
        return self.dense[code]

    def any_log_p(self, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """log P of each symbol after its context, of whatever classes; only if some class is 64 or more."""
        out, weight, left = np.empty(len(symbol)), np.ones(len(symbol)), np.arange(len(symbol))
        for k in range(self.order - 1, -1, -1):
            of, g, key, p = self.levels[k]
            short = last(context[left], k)
            row = np.minimum(np.searchsorted(of, short), len(of) - 1)
            known = of[row] == short
            want = row << WIDE | symbol[left]
            at = np.minimum(np.searchsorted(key, want), len(key) - 1)
            seen = known & (key[at] == want)
            out[left[seen]] = weight[left[seen]] * p[at[seen]]
            weight[left] *= np.where(known, g[row], 1.0)
            left = left[~seen]
        out[left] = weight[left] / self.vocabulary
        return np.log(out)

    def total(self, classes: np.ndarray) -> float:
        """log P of a text."""
        wide, total = classes >= 1 << BITS, 0.0
        codes = ngram_codes(np.where(wide, OTHER, classes), self.order)
        for at in range(0, len(codes), PIECE):
            total += float(self.dense[codes[at : at + PIECE]].sum(dtype=np.float64))
        if not wide.any():
            return total
        # n-grams with such a class are taken out again and looked up as they are
        near = np.convolve(wide, np.ones(self.order, np.int64))[: len(wide)] > 0
        total -= float(self.dense[codes[near]].sum(dtype=np.float64))
        context, symbol = contexts_of(classes, self.order)[near], classes[near].astype(np.int64)
        for at in range(0, len(symbol), PIECE):
            total += float(self.any_log_p(context[at : at + PIECE], symbol[at : at + PIECE]).sum())
        return total


def fit(trusted: DataFrame, order: int = ORDER) -> tuple[np.ndarray, Table] | None:
    """(class of each code point, log-probabilities) from the texts of ``trusted`` (column text)."""
    prepared_session(trusted.sparkSession)
    texts = staged(trusted.select("text").where("length(text) > 0"), "trusted")
    if texts.isEmpty():
        return None
    frequent = frequent_characters(texts)
    classes = class_of(frequent)
    vocabulary = FIRST - 1 + len(frequent)  # START is never predicted
    counts = staged(counted(texts, classes, order), "ngrams")
    return classes, Table(*probabilities(counts, order, vocabulary), vocabulary, FIRST + len(frequent))


def scored(docs: DataFrame, model: tuple[np.ndarray, Table] | None, text: str, name: str) -> DataFrame:
    """Append a struct ``name`` (n long, log_p double): characters scored and their log-probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("n long, log_p double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        got = shared.value
        for part in parts:
            out = []
            for t in part:
                if not t or got is None:
                    out.append((len(t or ""), 0.0))
                    continue
                classes = got[0][code_points(t)]
                out.append((len(classes), got[1].total(classes)))
            yield pd.DataFrame(out, columns=["n", "log_p"])

    return docs.withColumn(name, run(col(text)))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Column ``id``: documents that a label calls good and not toxic."""
    return labels.where("quality = 1 AND toxic = 0 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("id")).distinct()


def with_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose ``id`` is among ``ids`` (column id, distinct): a semi-join that leaves the rows' texts where they are.

    A bitmap of the ids' hashes, ``ID_BITS`` bits each and ``MOST_BITS`` at most, is broadcast. Of the ids that it lets
    through, those that are not among ``ids`` after all are found by a join of ids alone, and their rows go.
    """
    if rows.schema["id"].dataType != ids.schema["id"].dataType:
        return rows.join(ids, "id", "left_semi")
    bits = min(MOST_BITS, max(BUCKET, ids.count() * ID_BITS))
    place = F.pmod(F.xxhash64("id"), F.lit(bits))
    bucket, bit = F.floor(place / BUCKET).alias("bucket"), (place % BUCKET).cast("int")
    bitmaps = staged(ids.groupBy(bucket).agg(F.bitmap_construct_agg(bit.cast("long")).alias("bitmap")), "id-bitmaps")
    byte = F.conv(F.hex(F.substring("bitmap", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    known = rows.where("id IS NOT NULL").withColumn("bucket", bucket)
    found = known.join(F.broadcast(bitmaps), "bucket").where(F.getbit(byte, bit % 8) == 1).select(*rows.columns)
    others = staged(found.select("id").distinct().join(ids, "id", "left_anti"), "other-ids")
    return found.join(F.broadcast(others) if others.count() <= MOST_OTHERS else others, "id", "left_anti")


def classify(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, doc_id: str = "doc_id", text: str = "text",
             lang: str = "lang", quantile: float = QUANTILE) -> DataFrame:
    """Append ``n_symbols``, ``perplexity``, ``threshold``, ``kept``; clashing input columns are replaced."""
    prepared_session(docs.sparkSession)
    made = ["n_symbols", "perplexity", "threshold", "kept"]
    own = [c for c in (docs.columns if keep is None else keep) if c.lower() not in made]
    rows = docs.select(F.struct(*[col(c) for c in own]).alias("row"), col(doc_id).alias("id"), col(text).alias("text"), col(lang).alias("lang"))
    trusted = staged(trusted_ids(labels), "trusted-ids")
    half = F.pmod(F.xxhash64("id", F.lit("half")), F.lit(2)).alias("half")
    taught = staged(with_ids(rows.select("id", "lang", "text"), trusted).select("id", "lang", "text", half), "trusted-texts")
    model = fit(taught.select("text"))
    rows = staged(scored(rows, model, "text", "lm").select("row", "id", "lang", "lm.*"), "perplexity")
    if model is None:
        none = F.lit(None).cast("double")
        return rows.select("row.*", F.col("n").alias("n_symbols"), none.alias("perplexity"), none.alias("threshold"), (F.col("n") > 0).alias("kept"))
    known = rows.join(trusted, "id", "left_semi").where("n > 0")
    mean = F.sum("log_p") / F.sum("n")
    all_mean = known.agg(mean).first()[0]
    judged = by_language(rows, known.groupBy("lang").agg(mean.alias("mean")))
    known = by_language(known, known.groupBy("lang").agg(mean.alias("mean")))
    shrunk = F.exp(-(F.col("log_p") + SHRINK * F.coalesce("mean", F.lit(all_mean))) / (F.col("n") + SHRINK))
    top = lambda: F.percentile_approx(shrunk, quantile, 10000)
    means = known.select("lang", "mean").distinct()
    known = by_language(unseen_scores(taught, model).where("n > 0"), means)
    all_limit = known.agg(top()).first()[0]
    out = by_language(judged, known.groupBy("lang").agg(top().alias("limit")))
    perplexity, limit = F.when(F.col("n") > 0, shrunk), F.coalesce("limit", F.lit(all_limit))
    return out.select("row.*", F.col("n").alias("n_symbols"), perplexity.alias("perplexity"), limit.alias("threshold"),
                      F.coalesce(perplexity <= limit, F.lit(False)).alias("kept"))


def unseen_scores(taught: DataFrame, model: tuple) -> DataFrame:
    """(lang, n, log_p) of the trusted documents, each half by the model of the other; by ``model`` if there is none."""
    out = None
    for half in (0, 1):
        other = fit(taught.where(F.col("half") != half).select("text")) or model
        part = scored(taught.where(F.col("half") == half).select("lang", "text"), other, "text", "lm").select("lang", "lm.n", "lm.log_p")
        del other  # the driver need not hold it while the next is made
        out = part if out is None else out.unionByName(part)
    return staged(out, "unseen-scores")


def by_language(df: DataFrame, values: DataFrame) -> DataFrame:
    """``df`` with the values of its language (null is one too); as many rows as there are languages are broadcast."""
    if values.limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    values = values.withColumnRenamed("lang", "of_lang")
    return df.join(F.broadcast(values), F.col("lang").eqNullSafe(F.col("of_lang")), "left").drop("of_lang")



def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return classify(docs, table(spark, sf_dir, "labels"), keep=["doc_id", "lang"])
