"""SimHash near-duplicates by anchor points of a covering code.

Fingerprint: each w-word shingle of the text (repeats included) hashes to 64
bits; a bit is 1 if it is set in over half the hashes. Two texts link when
their fingerprints differ in at most ``distance`` bits (4 or fewer).

**Anchors.** The 64 bits are cut into three blocks of 22, 21 and 21 bits, each
seen as a word of 23 bits and covered by the perfect binary Golay code: 4,096
anchors, covering radius 3. Of at most 4 differing bits, some two of the three
blocks hold at most 2. For every pair of blocks the anchors are the pairs of
code words, 2**24 of them. Let m be a point halfway between two linked
fingerprints in those two blocks, one differing bit from either; the anchor
that covers m is within radius 3 + 1 of both in one block and 3 in the other.
So a fingerprint is replicated to every anchor within the covering radius plus
its half of the threshold - about 10 anchors a pair of blocks - and any linked
pair meets at one of them. The factor does not depend on the number of texts.

**Comparison per anchor.** Equal fingerprints are merged first. An anchor with more than ``CELL`` fingerprints is cut
into chunks by hash, every pair of chunks (and each chunk with itself) being
its own cell, so no task gets an unbounded group. A cell compares all its
fingerprints with XOR and a population count in numpy and returns a spanning
forest of its links, never all pairs: copies in the thousands give as many
rows as there are copies. Classes are the connected components of these links.

Defined results: a text without words (null, empty, blank) has fingerprint
zero and links like any other; a text with fewer words than a shingle is one
shingle. ``component_id`` is the smallest non-null id of the class, null if
none has one. Repeated rows share a class. Empty tables give no rows.
A very long text is fingerprinted whole, in the task that reads it. Columns of the
input keep their names; what the steps add is carried beside one struct of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import carried, col, fresh, prepared_session, staged, table

SHINGLE, DISTANCE, SEED = 4, 4, 42
CELL, SMALL, PIECE = 4096, 8, 1 << 16
BLOCKS = [(0, 22), (22, 21), (43, 21)]  # first bit, bits
#: Fixed value: generator polynomial of the binary Golay code of 23 bits.
GOLAY = 0b101011100011


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Fingerprint of a text as a signed 64-bit integer."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and the six ASCII blanks only
    if not raw:
        return 0
    line, size = b" ".join(raw), min(shingle, len(raw))
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    ends = np.cumsum(lengths + 1) - 1
    starts, stops = (ends - lengths).tolist(), ends[size - 1 :].tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(stops), PIECE):
        some = np.array([digest(line[a:b], SEED) for a, b in zip(starts[at : at + PIECE], stops[at : at + PIECE])], np.uint64)
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(stops), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str, name: str, shingle: int = SHINGLE) -> DataFrame:
    """Append the fingerprint as a long column ``name``."""

    @F.pandas_udf("long")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([fingerprint(t, shingle) for t in part], dtype="int64")

    return docs.withColumn(name, run(col(text)))


# --------------------------------------------------------------------- anchors

def golay_words() -> np.ndarray:
    """All 4,096 code words: multiples of the generator polynomial."""
    basis = [GOLAY << i for i in range(12)]
    words = np.zeros(1, np.int64)
    for b in basis:
        words = np.concatenate((words, words ^ b))
    return words


def syndromes(points: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit word by the generator polynomial: 11 bits, 0 for code words."""
    rest = points.copy()
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GOLAY << (bit - 11)), rest)
    return rest


def patterns() -> tuple[np.ndarray, list[np.ndarray]]:
    """By syndrome: the one error of weight 3 or less, and all errors of weight 4 or less."""
    home, near = np.zeros(2048, np.int64), [[] for _ in range(2048)]
    errors = np.array([sum(1 << b for b in bits) for n in range(5) for bits in combinations(range(23), n)], np.int64)
    for e, s in zip(errors.tolist(), syndromes(errors).tolist()):
        if e.bit_count() <= 3:
            home[s] = e
        near[s].append(e)
    return home, [np.array(x, np.int64) for x in near]


def anchor_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replicas (index of the fingerprint, anchor key) of distinct fingerprints."""
    home, near = patterns()
    width = max(map(len, near))
    padded = np.full((2048, width), -1, np.int64)
    for s, x in enumerate(near):
        padded[s, : len(x)] = x
    bits = prints.view(np.uint64)
    blocks = [((bits >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in BLOCKS]
    marks = [syndromes(b) for b in blocks]
    homes = [b ^ home[s] for b, s in zip(blocks, marks)]
    index, keys = [], []
    rows = np.arange(len(prints))
    for t, (i, j) in enumerate(combinations(range(3), 2)):
        key = lambda a, b: (np.int64(t) << 46) | (a << 23) | b
        around = lambda k: np.where((e := padded[marks[k]]) >= 0, blocks[k][:, None] ^ e, -1)
        home_i, home_j, first, second = homes[i][:, None], homes[j][:, None], around(i), around(j)
        # the nearest code word in one block, all within 4 in the other; the nearest pair itself once
        for wide, made, ok in ((first, key(first, home_j), first >= 0), (second, key(home_i, second), (second >= 0) & (second != home_j))):
            index.append(np.broadcast_to(rows[:, None], wide.shape)[ok])
            keys.append(made[ok])
    return np.concatenate(index), np.concatenate(keys)


# ------------------------------------------------------------------ comparison

def forest(prints: np.ndarray, distance: int) -> tuple[list[int], list[int]]:
    """A spanning forest of the links among ``prints``: each one reached takes what is near it from the rest."""
    a, b, rest = [], [], np.arange(len(prints))
    while len(rest):
        reached, rest = [int(rest[0])], rest[1:]
        while reached and len(rest):
            x = reached.pop()
            near = np.bitwise_count(prints[rest] ^ prints[x]) <= distance
            if near.any():
                new = rest[near].tolist()
                rest = rest[~near]
                a += [x] * len(new)
                b += new
                reached += new
    return a, b


def cell_links(cell: np.ndarray, prints: np.ndarray, distance: int) -> pd.DataFrame:
    """Links of whole cells that follow one another: all those of up to ``SMALL`` rows, a forest of larger ones."""
    new = np.any(cell[1:] != cell[:-1], axis=1)
    cuts = np.concatenate(([0], np.flatnonzero(new) + 1, [len(prints)]))
    sizes = np.diff(cuts)
    own, which = np.repeat(sizes, sizes), np.repeat(np.arange(len(sizes)), sizes)
    few = own <= SMALL
    p, w = prints[few], which[few]
    a, b = [], []
    for d in range(1, SMALL):
        near = np.flatnonzero((w[:-d] == w[d:]) & (np.bitwise_count(p[:-d] ^ p[d:]) <= distance)) if len(p) > d else []
        a.append(p[near])
        b.append(p[np.add(near, d)] if len(near) else p[:0])
    for at, size in zip(cuts[:-1][sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
        x, y = forest(part := prints[at : at + size], distance)
        a.append(part[x])
        b.append(part[y])
    return pd.DataFrame({"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)})


def compare(distance: int):
    """Links of the cells in a partition sorted by cell; a cell may run over batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, prints = np.empty((0, 2), np.int64), np.empty(0, np.uint64)
        for batch in batches:
            cell = np.concatenate((cell, batch[["key", "part"]].to_numpy(np.int64)))
            prints = np.concatenate((prints, batch["print"].to_numpy(np.int64).view(np.uint64)))
            ended = np.flatnonzero(np.any(cell != cell[-1], axis=1))
            if len(ended):
                done = int(ended[-1]) + 1
                yield cell_links(cell[:done], prints[:done], distance)
                cell, prints = cell[done:], prints[done:]
        if len(prints):
            yield cell_links(cell, prints, distance)

    return run


def link(prints: DataFrame, name: str, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) that connect the distinct longs of column ``name`` within ``distance`` bits."""
    if not 0 <= distance <= 4:
        raise ValueError("the anchors cover distances up to 4")

    def replicate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = batch["print"].to_numpy(np.int64)
            for at in range(0, len(own), 4096):
                index, keys = anchor_keys(own[at : at + 4096])
                yield pd.DataFrame({"key": keys, "print": own[at : at + 4096][index]})

    distinct = prints.select(F.col(name).alias("print")).distinct()
    replicas = distinct.mapInPandas(replicate, "key long, print long")
    crowded = replicas.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > CELL)
    marked = replicas.join(crowded, "key", "left")
    chunks = F.ceil(F.col("n") / CELL).cast("int")
    mine = F.pmod(F.xxhash64("print"), chunks).cast("int")
    # cells of a crowded anchor: one for each unordered pair of its chunks
    cell = F.transform(F.sequence(F.lit(0), chunks - 1), lambda k: F.least(mine, k) * chunks + F.greatest(mine, k))
    cells = marked.select("key", "print", F.explode(F.when(F.col("n").isNull(), F.array(F.lit(0))).otherwise(cell)).alias("part"))
    dealt = cells.repartition("key", "part").sortWithinPartitions("key", "part")
    return dealt.mapInPandas(compare(distance), "a long, b long").where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct()


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, label): the smallest node of each connected component of ``edges`` (a, b longs).

    Alternates large-star and small-star steps: the number of steps is
    logarithmic in practice, each is one shuffle of the links that are left, and
    each step's table is written to the shared folder.
    """

    def settled(df: DataFrame) -> tuple[DataFrame, tuple]:
        out = staged(df.distinct(), "components")
        sums = out.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return out, tuple(sums)

    edges, before = settled(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b"))
    for _ in range(most):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small_ = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges, now = settled(small_.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
        if now == before:
            tops = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(tops)
        before = now
    raise RuntimeError("components did not settle")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None,
            shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Append ``fingerprint`` (hex), ``component_id`` and ``class_print`` (the class's smallest fingerprint)."""
    prepared_session(docs.sparkSession)
    made = ["fingerprint", "component_id", "class_print"]
    own = [c for c in (docs.columns if keep is None else keep) if c.lower() not in made]
    fp = fresh(docs, "print_")
    marked = staged(fingerprints(docs, text, fp, shingle).select(*[col(c) for c in own], fp), "simhash")
    labels = components(link(marked, fp, distance)).withColumnRenamed("node", fp)
    firsts = marked.groupBy(fp).agg(F.min(col(doc_id)).alias("first"))
    firsts = firsts.join(labels, fp, "left").select(fp, "first", F.coalesce("label", fp).alias("label"))
    ids = firsts.groupBy("label").agg(F.min("first").alias("component_id"))
    by_print = firsts.join(ids, "label").select(fp, F.col("label").alias("class_print"), "component_id")
    joined = marked.join(by_print, fp)
    return joined.select(*[col(c) for c in own], F.lower(F.lpad(F.hex(fp), 16, "0")).alias("fingerprint"), "component_id", "class_print")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` with one row of each class: the one with the smallest id.

    Where an id stands in several rows of a class, or a class has no id, any
    one of those rows stays.
    """
    marked = classes(carried(docs, doc_id=doc_id, text=text), keep=["row", "doc_id"], shingle=shingle, distance=distance)
    first = marked.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    repeated = first.groupBy("class_print").agg(F.count("*").alias("n")).where("n > 1")
    if not repeated.isEmpty():
        first = first.dropDuplicates(["class_print"])
    return first.select("row.*")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classes(docs, keep=["doc_id"]).select("doc_id", "fingerprint", "component_id")
