"""Katz backoff bigram model: Good-Turing discounts, exactly normalised backoff weights, scores of all texts.

Tokens are a text's words, lower-cased A-Z, and one end; the first has the
start as its history. With c training counts, r a count and d its discount:

    P(w | h) = d(c(hw)) c(hw) / c(h)      if the pair was seen
             = alpha(h) P(w)              if the history was
             = P(w)                       if neither was
    P(w)     = d(c(w)) c(w) / N           for a seen word; the rest of the mass is one unseen word's

Counts up to 5 are discounted by Good-Turing with Katz's correction, each r whose
counts of counts do not allow it by their log-linear fit (``discounted``). Larger counts give up ``EPSILON`` of a
count, so every history leaves some mass and alpha(h), the mass left over
divided by the unigram mass of unseen words, makes P(. | h) sum to one exactly.

**Distribution.** One exchange takes every (word, history, document, count) to
the shard of its word - of its pair, for the ``SPREAD`` most frequent words,
whose counts are taken beforehand, so that no word makes a hot shard. There the
pair's and the word's counts are sums of what came. What a document needs from
a shard is small: how many of its tokens have which low count (the discounts
are known only when all shards are), and sums of logarithms of larger ones.
Pairs go on to shards of their history, which make alpha(h) and add it where a
document backed off. Sums meet by group of documents. Nothing is broadcast but
``HOT`` frequent words of a sample, which merely shortens what is shuffled:
frequent words travel as small numbers, others as 64-bit hashes; results do
not depend on it. Rows carry packed arrays (sorted, byte planes, zstd), as
plain rows would take three times the disk.

The model lies in tables partitioned by kind under the shared folder: pair
counts with their words (``bigram``, by shard), backoff weights (``alpha``)
and counts of counts (``total``).

Defined results: a null or empty text has one token, its end. A null id teaches
nothing and is not held out. Other columns, whatever their names, are not read. Repeated rows count as separate documents. Without
any training document every score is 0 (one unseen word has all the mass).
"""

from __future__ import annotations

import struct
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import col, passing_shuffles, prepared_session, table
from daybook.session import work_path

HOT, SPREAD, SAMPLE, FLUSH, SHARD, LOW, EPSILON = 1 << 18, 4096, 64, 1 << 20, 1 << 20, 5, 0.01
START, END, FIRST = 0, 1, 2
ROWS = "kind string, shard int, part long, blob binary, words binary"
INTS = 2 + LOW + 2 + LOW  # n, known, seen once to five times, unseen word, backed off to 1..5, to more


# ---------------------------------------------------------------------- packing

def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of equal or different lengths as one string: byte planes of each, compressed."""
    zstd = zstandard.ZstdCompressor(level=1)
    out = []
    for a in arrays:
        planes = np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()
        body = zstd.compress(planes)
        out.append(struct.pack("<4sqq", a.dtype.str.encode(), len(a), len(body)) + body)
    return b"".join(out)


def unpack(blob: bytes) -> list[np.ndarray]:
    zstd, out, at = zstandard.ZstdDecompressor(), [], 0
    while at < len(blob):
        kind, n, size = struct.unpack_from("<4sqq", blob, at)
        dtype = np.dtype(kind.rstrip(b"\0").decode())
        planes = zstd.decompress(blob[at + 20 : at + 20 + size], max_output_size=max(1, n * dtype.itemsize)) if n else b""
        out.append(np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(dtype.itemsize, n).T).reshape(-1).view(dtype))
        at += 20 + size
    return out


def steps(sorted_: np.ndarray) -> np.ndarray:
    """Differences of an ascending array, its first value first: small numbers pack well."""
    return np.diff(sorted_, prepend=sorted_[:1] * 0)


def small(a: np.ndarray) -> np.ndarray:
    """The narrowest unsigned type that holds the values."""
    top = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def shard_of(a: np.ndarray, shards: int) -> np.ndarray:
    """A shard for each integer."""
    mixed = a.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(33)).astype(np.int64) % shards


# ----------------------------------------------------------------------- tokens

def words_of(text: str | None) -> list[bytes]:
    """Words of a text; on bytes, lower() changes A-Z and split() parts at the six ASCII blanks only."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 10; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 10


def hot_words(docs: DataFrame, sample: int) -> list[bytes]:
    """Frequent words of one in ``sample`` documents, most frequent first; at most ``HOT``."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            c: Counter[bytes] = Counter()
            for t in batch["text"]:
                c.update(words_of(t))
            yield pd.DataFrame({"w": list(c.keys()), "n": list(c.values())})

    some = docs.where(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(sample)) == 0).select("text")
    sums = some.mapInPandas(count, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n"))
    rows = sums.where(F.length("w") <= 64).orderBy(F.desc("n"), "w").limit(HOT - FIRST).collect()
    return [bytes(r.w) for r in rows]


def spread_counts(docs: DataFrame, hot, spread: int) -> tuple[np.ndarray, int]:
    """Training counts of the end and of the ``spread`` first hot words, by code; number of all tokens."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = {w: i + FIRST for i, w in enumerate(hot.value[:spread])}
        total = np.zeros(spread + FIRST, np.int64)
        for batch in batches:
            for t, teaches in zip(batch["text"], batch["teaches"]):
                words = words_of(t)
                total[START] += len(words) + 1
                if teaches:
                    total[END] += 1
                    for w, n in Counter(words).items():
                        if (code := own.get(w)) is not None:
                            total[code] += n
        at = np.flatnonzero(total)
        yield pd.DataFrame({"code": at, "n": total[at]})

    rows = docs.select("text", "teaches").mapInPandas(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(spread + FIRST, np.int64)
    for r in rows:
        out[r.code] = r.n
    tokens, out[START] = int(out[START]), 0
    return out, tokens


# ------------------------------------------------------- first exchange: by word

def deal(hot, spread: int, shards: int):
    """Documents to rows of pairs, one for each shard and group of documents, and one row of the group's ids."""

    def flush(part: int, texts: list[np.ndarray], ids: list, teaches: list) -> pd.DataFrame:
        n = np.array([len(t) for t in texts])
        w = np.concatenate(texts)
        h = np.concatenate(([START], w[:-1]))
        h[np.concatenate(([0], np.cumsum(n)[:-1]))] = START
        doc = np.repeat(np.arange(len(texts)) * 2 + np.array(teaches, np.int64), n)
        frequent = (w >= END) & (w < spread + FIRST)
        shard = shard_of(np.where(frequent, w ^ (h * 1_000_003), w), shards)
        order = np.lexsort((doc, h, w, shard))
        w, h, doc, shard = w[order], h[order], doc[order], shard[order]
        first = np.concatenate(([True], (w[1:] != w[:-1]) | (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])))
        at = np.flatnonzero(first)
        count = np.diff(np.append(at, len(w)))
        w, h, doc, shard = w[at], h[at], doc[at], shard[at]
        cuts = np.searchsorted(shard, np.arange(shards + 1))
        rows = []
        for s in range(shards):
            a, b = int(cuts[s]), int(cuts[s + 1])
            if a < b:
                # a word stands once, with the number of its pairs
                new = np.concatenate(([True], w[a + 1 : b] != w[a : b - 1]))
                runs = np.diff(np.append(np.flatnonzero(new), b - a))
                rows.append(("pair", s, part, pack(w[a:b][new], small(runs), h[a:b], small(doc[a:b]), small(count[a:b])), b""))
        held = pack(np.array([i for i, _ in ids], np.int64), np.array([k for _, k in ids], np.uint8))
        rows.append(("group", part % shards, part, held, b""))
        return pd.DataFrame(rows, columns=["kind", "shard", "part", "blob", "words"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = {w: i + FIRST for i, w in enumerate(hot.value)}
        get, digest = own.get, xxhash.xxh64_intdigest
        texts, ids, teaches, held, flushes = [], [], [], 0, 0
        part = TaskContext.get().partitionId() << 32
        for batch in batches:
            for i, known, t, taught in zip(batch["doc_id"].tolist(), batch["known"].tolist(), batch["text"], batch["teaches"]):
                codes = [get(w) or (digest(w) | 1 << 63) - (1 << 64) for w in words_of(t)]
                codes.append(END)
                texts.append(np.array(codes, np.int64))
                ids.append((i, known))
                teaches.append(bool(taught))
                held += len(codes)
                if held >= FLUSH:
                    yield flush(part + flushes, texts, ids, teaches)
                    texts, ids, teaches, held, flushes = [], [], [], 0, flushes + 1
        if texts:
            yield flush(part + flushes, texts, ids, teaches)

    return run


def by_shard(batches: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[tuple[int, pd.DataFrame]]:
    """Whole shards of a partition sorted by shard; one is held at a time."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        for shard, rows in batch[columns].groupby("shard", sort=False):
            if held and held[0]["shard"].iloc[0] != shard:
                yield int(held[0]["shard"].iloc[0]), pd.concat(held)
                held = []
            held.append(rows)
    if held:
        yield int(held[0]["shard"].iloc[0]), pd.concat(held)


def starts_of(*keys: np.ndarray) -> np.ndarray:
    """Where a new key begins in arrays sorted by it."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def low(counts: np.ndarray, weights: np.ndarray, first: int) -> list[np.ndarray]:
    """For each r from ``first`` to ``LOW``: the weight where the count is r."""
    return [np.where(counts == r, weights, 0) for r in range(first, LOW + 1)]


def per_document(doc: np.ndarray, ints: list[np.ndarray], floats: list[np.ndarray]) -> bytes:
    """Sums over a group's documents, packed: document, the integers' columns, the floats'."""
    there, at = np.unique(doc, return_inverse=True)
    total = lambda x: np.bincount(at, weights=x, minlength=len(there))
    return pack(small(there), *[small(total(x).astype(np.int64)) for x in ints], *[total(x) for x in floats])


def document_sums(doc: np.ndarray, n: np.ndarray, c: np.ndarray, u: np.ndarray) -> bytes:
    """A group's sums from one shard; by token: how often, its pair's count, its word's count."""
    backed = np.where(c == 0, n, 0)
    log = lambda x: np.log10(np.where(x > 0, x, 1.0))
    floats = [
        np.where(c > LOW, n * log(c - EPSILON), 0) + np.where((c == 0) & (u > LOW), n * log(u - EPSILON), 0) - np.where(u > 0, n * log(u), 0),
        n * np.log10(u + 0.1),
    ]
    ints = [n, np.where(u > 0, n, 0), *low(c, n, 1), *low(u, backed, 0), np.where(u > LOW, backed, 0)]
    return per_document(doc, ints, floats)


def count_and_score(spread: np.ndarray, shards: int):
    """A shard of words: its part of every document's sums, its pairs by history, its counts of counts."""

    def one(rows: pd.DataFrame) -> list[tuple]:
        out = [("group", 0, p, b, b"") for k, p, b in zip(rows["kind"], rows["part"], rows["blob"]) if k == "group"]
        parts, cols = [], []
        for k, p, b in zip(rows["kind"], rows["part"], rows["blob"]):
            if k == "pair":
                w, runs, h, doc, count = unpack(b)
                parts.append(p)
                cols.append((np.repeat(w, runs.astype(np.int64)), h, doc.astype(np.int32), count.astype(np.int32)))
        if not cols:
            return out
        sizes = [len(c[1]) for c in cols]
        w, h, doc, n = (np.concatenate([c[i] for c in cols]) for i in range(4))
        del cols
        order = np.lexsort((h, w))
        ws, hs, taught = w[order], h[order], (n * (doc & 1))[order]
        pair, word = starts_of(ws, hs), starts_of(ws)
        c_pair = np.add.reduceat(taught, pair)
        c_word = np.add.reduceat(taught, word)
        codes = ws[word]
        is_spread = (codes >= END) & (codes < len(spread))
        c_word = np.where(is_spread, spread[np.clip(codes, 0, len(spread) - 1)], c_word)
        pair_size, word_size = np.diff(np.append(pair, len(ws))), np.diff(np.append(word, len(ws)))
        del w
        c, u = np.empty(len(ws), np.int64), np.empty(len(ws), np.int64)
        c[order], u[order] = np.repeat(c_pair, pair_size), np.repeat(c_word, word_size)
        del order, taught
        at = 0
        for p, size in zip(parts, sizes):
            part = slice(at, at + size)
            out.append(("document", 0, p, document_sums(doc[part] >> 1, n[part], c[part], u[part]), b""))
            at += size
        backed = np.where(c == 0, n, 0)
        # pairs seen, to their history's shard
        known = c_pair > 0
        ph, pw, pc = hs[pair][known], ws[pair][known], c_pair[known]
        pu = c_word[np.searchsorted(word, pair, side="right") - 1][known]
        to = shard_of(ph, shards)
        order = np.lexsort((pw, ph, to))
        ph, pw, pc, pu, to = ph[order], pw[order], pc[order], pu[order], to[order]
        cuts = np.searchsorted(to, np.arange(shards + 1))
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            a, b = int(cuts[s]), int(cuts[s + 1])
            out.append(("bigram", s, 0, pack(steps(ph[a:b]), small(pc[a:b]), small(pu[a:b])), pack(pw[a:b])))
        # where a document backed off, likewise
        miss = np.flatnonzero(backed)
        group = np.repeat(np.array(parts, np.int64), sizes)[miss]
        to = shard_of(h[miss], shards)
        order = np.argsort(to, kind="stable")
        miss, group, to = miss[order], group[order], to[order]
        cuts = np.searchsorted(to, np.arange(shards + 1))
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            m, g = miss[cuts[s] : cuts[s + 1]], group[cuts[s] : cuts[s + 1]]
            out.append(("miss", s, 0, pack(g, small(doc[m] >> 1), h[m], small(backed[m])), b""))
        own = c_word[~is_spread]
        out.append(("total", 0, 0, pack(totals(own), totals(c_pair)), b""))
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, rows in by_shard(batches, ["kind", "shard", "part", "blob"]):
            made = one(rows)
            for at in range(0, len(made), 256):
                yield pd.DataFrame(made[at : at + 256], columns=["kind", "shard", "part", "blob", "words"])

    return run


def totals(counts: np.ndarray) -> np.ndarray:
    """Sum of the counts, how many there are, and how many equal 1 to 6."""
    return np.array([counts.sum(), (counts > 0).sum(), *[(counts == r).sum() for r in range(1, LOW + 2)]], np.int64)


def discounted(t: np.ndarray) -> np.ndarray:
    """r d(r) for r from 0 to 5, from ``totals``; r of 0 is 0.

    A count r whose own Good-Turing discount lies outside (0, 1) takes that of
    the log-linear fit of the counts of counts (as in Simple Good-Turing), the
    others keep theirs. (r - 1/2)/r is left for a level where one of n(1) to
    n(6) is none, and for an r to which the fit gives no discount either.
    """
    n = t[1:].astype(float)  # n[r]: how many counts equal r, from 1 to 6
    r = np.arange(1, LOW + 1)
    plain = (r - 0.5) / r
    if (n[1:] <= 0).any():
        return np.append(0.0, plain * r)
    katz = lambda turing, a: (turing - a) / (1 - a) if a < 1 else np.zeros(LOW)
    valid = lambda d: (d > 0) & (d < 1)
    slope = np.polyfit(np.log(np.arange(1, LOW + 2)), np.log(n[1:]), 1)[0]
    own = katz((r + 1) * n[2:] / (r * n[1:-1]), (LOW + 1) * n[LOW + 1] / n[1])
    fit = katz((1 + 1 / r) ** (slope + 1), (LOW + 1) ** (slope + 1))
    return np.append(0.0, np.where(valid(own), own, np.where(valid(fit), fit, plain)) * r)


class Discounts:
    """The constants known once all shards are counted."""

    def __init__(self, unigrams: np.ndarray, bigrams: np.ndarray):
        self.n, self.v = int(unigrams[0]), int(unigrams[1])
        self.one, self.two = discounted(unigrams), discounted(bigrams)
        lost = sum((r - self.one[r]) * unigrams[1 + r] for r in range(1, LOW + 1))
        self.unseen = (lost + EPSILON * (self.v - unigrams[2 : 2 + LOW].sum())) / self.n if self.n else 1.0

    @staticmethod
    def kept(counts: np.ndarray, table_: np.ndarray) -> np.ndarray:
        """Count times discount."""
        return np.where(counts > LOW, counts - EPSILON, table_[np.minimum(counts, LOW).astype(np.int64)])


# ---------------------------------------------------- second exchange: by history

def back_off(d: Discounts):
    """A shard of histories: their backoff weights, and the weights' sums for the documents that need them."""

    def one(shard: int, rows: pd.DataFrame) -> list[tuple]:
        pairs = [unpack(b) for k, b in zip(rows["kind"], rows["blob"]) if k == "bigram"]
        misses = [unpack(b) for k, b in zip(rows["kind"], rows["blob"]) if k == "miss"]
        if not pairs:
            return []
        h = np.concatenate([np.cumsum(p[0]) for p in pairs])
        c, u = (np.concatenate([p[i].astype(np.int64) for p in pairs]) for i in (1, 2))
        order = np.argsort(h, kind="stable")
        h, c, u = h[order], c[order], u[order]
        at = starts_of(h)
        total = np.add.reduceat(c, at)
        left = np.add.reduceat(c - d.kept(c, d.two), at) / total
        alpha = left / (1 - np.add.reduceat(d.kept(u, d.one), at) / d.n)
        out = [("alpha", shard, 0, pack(h[at], alpha, small(total)), b"")]
        if misses:
            part, doc, mh, n = (np.concatenate([m[i].astype(np.int64) for m in misses]) for i in range(4))
            where = np.minimum(np.searchsorted(h[at], mh), len(at) - 1)
            known = h[at][where] == mh
            part, doc, n, where = part[known], doc[known], n[known], where[known]
            gain = n * (np.log10(alpha) + np.log10(total))[where]
            order = np.argsort(part, kind="stable")
            part, doc, gain = part[order], doc[order], gain[order]
            cuts = np.append(starts_of(part), len(part)) if len(part) else []
            for a, b in zip(cuts[:-1], cuts[1:]):
                none = np.zeros(b - a)
                out.append(("document", 0, int(part[a]), per_document(doc[a:b], [none] * INTS, [gain[a:b], none]), b""))
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for shard, rows in by_shard(batches, ["kind", "shard", "blob"]):
            made = one(shard, rows)
            for at in range(0, len(made), 256):
                yield pd.DataFrame(made[at : at + 256], columns=["kind", "shard", "part", "blob", "words"])

    return run


# ------------------------------------------------------ third exchange: by document

def finish(d: Discounts):
    """Sums of one group of documents to its rows."""
    logs = lambda x: np.log10(np.where(x > 0, x, 1.0))[1:]
    log_n = np.log10(d.n) if d.n else 0.0

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        ids, known = next(unpack(b) for k, b in zip(rows["kind"], rows["blob"]) if k == "group")
        ints, floats = np.zeros((INTS, len(ids))), np.zeros((2, len(ids)))
        for k, b in zip(rows["kind"], rows["blob"]):
            if k == "document":
                doc, *fields = unpack(b)
                doc = doc.astype(np.int64)
                for i, f in enumerate(fields):
                    target = ints[i] if i < INTS else floats[i - INTS]
                    target[doc] += f
        n, n_known = ints[0], ints[1]
        seen, unseen, backed, more = ints[2 : 2 + LOW], ints[2 + LOW], ints[3 + LOW : 3 + 2 * LOW], ints[3 + 2 * LOW]
        score = floats[0] + logs(d.two) @ seen + (logs(d.one) - log_n) @ backed - more * log_n + unseen * np.log10(d.unseen)
        base = floats[1] - n * np.log10(d.n + 0.1 * (d.v + 1))
        doc_id = pd.array(ids, dtype="Int64")
        doc_id[known == 0] = pd.NA
        return pd.DataFrame({"doc_id": doc_id, "n_tokens": n.astype(np.int64), "n_known": n_known.astype(np.int64), "base_score": base, "score": score})

    return run


def score_documents(docs: DataFrame, teaches: Column, doc_id: str = "doc_id", text: str = "text", model: str | None = None,
                    sample: int = SAMPLE, spread: int = SPREAD) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row; ``teaches`` marks what to learn from.

    ``doc_id`` must be an integer column. The model's tables are written to
    ``model`` (default: a new folder under the shared one).
    """
    spark = prepared_session(docs.sparkSession)
    model = model or work_path(spark, "katz")
    ids = col(doc_id).cast("long")
    slim = docs.select(F.coalesce(ids, F.lit(0)).alias("doc_id"), ids.isNotNull().alias("known"), col(text).alias("text"), F.coalesce(teaches, F.lit(False)).alias("teaches"))
    hot = spark.sparkContext.broadcast(hot_words(slim, sample))
    frequent, tokens = spread_counts(slim, hot, spread)
    shards = max(4, -(-tokens // SHARD))  # by the size of the text: a shard is what one task holds at once
    dealt = slim.mapInPandas(deal(hot, spread, shards), ROWS).repartition(shards, "shard").sortWithinPartitions("shard")
    with passing_shuffles(spark):
        dealt.mapInPandas(count_and_score(frequent, shards), ROWS).write.partitionBy("kind").parquet(f"{model}/counts")
    counts = spark.read.schema(ROWS).parquet(f"{model}/counts")
    unigrams, bigrams = totals(frequent), np.zeros(LOW + 3, np.int64)
    # one short row a shard
    for r in counts.where("kind = 'total'").select("blob").collect():
        one, two = unpack(bytes(r.blob))
        unigrams, bigrams = unigrams + one, bigrams + two
    d = Discounts(unigrams, bigrams)
    histories = counts.where("kind IN ('bigram', 'miss')").select("kind", "shard", "blob").repartition(shards, "shard").sortWithinPartitions("shard")
    with passing_shuffles(spark):
        histories.mapInPandas(back_off(d), ROWS).write.partitionBy("kind").parquet(f"{model}/weights")
    weights = spark.read.schema(ROWS).parquet(f"{model}/weights")
    sums = counts.where("kind IN ('document', 'group')").select("kind", "part", "blob").unionByName(weights.where("kind = 'document'").select("kind", "part", "blob"))
    out = sums.groupBy("part").applyInPandas(finish(d), "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(d.n).cast("long"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score_documents(docs, remainder(F.col("doc_id")) != 0)
    held_out = F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
