"""Source divergence audit: how far each source's term frequencies are from the other sources of its language.

Counting is single-pass in-memory indexing. A task builds a block of postings
(language, source, term -> occurrences, documents) until ``BLOCK`` of them are
held, then spills it as term-sorted runs, cut by the term's hash into shards,
and starts anew. The runs are a written table: one row for a run's part of a
shard, its terms in order. Per (language, shard) a heap merges the runs, a
block of each at a time, and equal terms are added up; those in enough documents are the frequencies.

Let a group be one (language, source). A term's share p in a group without it
is the same number z for all such terms, so the distance of groups a and b is
V |z_a - z_b|, as if both lacked every term, and a correction
|p_a - p_b| - |z_a - z_b| for each term that a or b has. The corrections are
streamed from each shard's merged postings, a chunk of terms at a time, into a
square of sums for a tile of ``TILE`` sources against another.

Bounds: a block holds ``BLOCK`` postings and one text's words; a merge reads
``FAN_IN`` runs of a shard, and where there are more they are merged in
rounds, so a term that every run holds is summed up before its shard sees it; there is a shard for
each ``SHARD`` bytes of text. Nothing of the corpus passes through the
driver but the number of runs.

Defined results: null text, language and source are empty ones. Repeated rows
count each. A text without terms, or a group without kept terms, still has
its group's rows: shares are those of zero counts, and distances are 0 where a
language keeps no term. A very long text is read in pieces of ``CHUNK`` bytes;
its distinct words are held once, so that it counts as one document. Ties in a
rank go to the smaller name in UTF-8. An empty table gives no rows. Other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import bisect
import heapq
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.llm.common import col, prepared_session, staged, table

MIN_DOCS, SMOOTH, SCALE, TOP = 30, 5, 1_000_000_000, 50
BLOCK, CHUNK, SHARD, FAN_IN, STEP, TILE, TERMS = 400_000, 1 << 22, 1 << 24, 256, 4096, 256, 4096
#: Terms are runs of ASCII letters and all beyond ASCII, A-Z lower-cased: everything else becomes a blank.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))
RUN = "lang string, shard int, run long, names array<string>, terms array<binary>, source array<int>, n array<long>, docs array<long>"
POSTING = ["terms", "source", "n", "docs"]


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in order, ``CHUNK`` bytes or a little more at a time."""
    text, at = text.translate(LETTERS), 0
    while at < len(text):
        stop = text.find(b" ", at + CHUNK) if at + CHUNK < len(text) else -1
        stop = len(text) if stop < 0 else stop
        yield text[at:stop].split(b" ")
        at = stop


class Block:
    """Postings in memory: per group, occurrences and documents of each term."""

    def __init__(self):
        self.groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        self.held = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        n, docs = self.groups.setdefault((lang, source), (Counter(), Counter()))
        before, seen = len(n), None
        for terms in pieces(text):
            own = set(terms)
            n.update(terms)
            docs.update(own if seen is None else own - seen)
            if len(text) > CHUNK:
                seen = own if seen is None else seen | own
        self.held += len(n) - before

    def spill(self, run: int, shards: int) -> Iterator[pa.RecordBatch]:
        """The block as one run: a row for each language and shard, its postings in order of term and source."""
        for lang in {lang for lang, _ in self.groups}:
            names = [source for other, source in self.groups if other == lang]
            parts = []
            for k, source in enumerate(names):
                n, docs = self.groups[lang, source]
                n.pop(b"", None)
                terms = list(n)
                shard = np.array([zlib.crc32(t) for t in terms], np.int64) % shards
                parts.append(pa.table({"shard": pa.array(shard, pa.int32()), "terms": pa.array(terms, pa.binary()), "source": pa.array([k] * len(terms), pa.int32()),
                                       "n": pa.array(n.values(), pa.int64()), "docs": pa.array([docs[t] for t in terms], pa.int64())}))
            postings = pa.concat_tables(parts).sort_by([("shard", "ascending"), ("terms", "ascending"), ("source", "ascending")]).combine_chunks()
            held, sizes = np.unique(postings["shard"].to_numpy(), return_counts=True)
            rows = zip(held.tolist(), np.cumsum(sizes) - sizes, sizes)
            yield from (run_row(lang, shard, run, names, postings.slice(at, size)) for shard, at, size in rows)


def run_row(lang: str, shard: int, run: int, names: list[str], postings: pa.Table) -> pa.RecordBatch:
    lists = [pa.array([names], pa.list_(pa.string()))]
    for c in POSTING:
        values = postings[c].combine_chunks() if postings[c].num_chunks != 1 else postings[c].chunk(0)
        lists.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
    return pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), pa.array([shard], pa.int32()), pa.array([run], pa.int64()), *lists], names=["lang", "shard", "run", "names", *POSTING])


def runs_of(docs: DataFrame, shards: int, block: int = BLOCK) -> DataFrame:
    """Term-sorted runs of ``docs`` (lang, source, text)."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, run = Block(), TaskContext.get().partitionId() << 24
        for batch in batches:
            for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), batch["text"].cast(pa.binary())):
                held.add(lang, source, text.as_py())
                if held.held >= block:
                    yield from held.spill(run, shards)
                    held, run = Block(), run + 1
        yield from held.spill(run, shards)

    return docs.mapInArrow(index, RUN)


def merged(rows: pa.Table) -> Iterator[pa.Table]:
    """The postings of all runs, term range by term range, in order; ``source`` numbers ``names_in`` the rows.

    Of each run a block of its postings is loaded, whole terms only, and a heap holds the blocks by their last terms. What
    stands up to the least of these is complete: it is cut off all blocks, and the runs whose block is used up load the next."""
    names = {s: k for k, s in enumerate(names_in(rows))}
    own = [pa.array([names[s] for s in row], pa.int32()) for row in rows["names"].to_pylist()]
    runs = [[rows[c][k].values for c in POSTING] for k in range(len(rows))]
    keys: list[list[bytes]] = [[]] * len(runs)
    base, used, heap = [0] * len(runs), [0] * len(runs), []

    def load(k: int) -> None:
        terms = runs[k][0]
        base[k] += len(keys[k])
        stop = min(base[k] + STEP, len(terms))
        while stop < len(terms) and terms[stop] == terms[stop - 1]:
            stop += 1
        keys[k], used[k] = terms[base[k] : stop].to_pylist(), 0
        if keys[k]:
            heapq.heappush(heap, (keys[k][-1], k))

    for k in range(len(runs)):
        load(k)
    while heap:
        least, parts = heap[0][0], []
        for k, block in enumerate(keys):
            if (stop := bisect.bisect_right(block, least, used[k])) > used[k]:
                part = slice(base[k] + used[k], base[k] + stop)
                terms, source, n, docs = (c[part] for c in runs[k])
                parts.append(pa.table({"terms": terms, "source": own[k].take(source), "n": n, "docs": docs}))
                used[k] = stop
        while heap and heap[0][0] == least:
            load(heapq.heappop(heap)[1])
        yield pa.concat_tables(parts)


def names_in(rows: pa.Table) -> list[str]:
    return sorted({s for row in rows["names"].to_pylist() for s in row})


def summed(postings: pa.Table) -> pa.Table:
    """Postings in order of term and source, those of equal ones added up."""
    sums = postings.group_by(["terms", "source"]).aggregate([("n", "sum"), ("docs", "sum")]).rename_columns(POSTING)
    return sums.sort_by([("terms", "ascending"), ("source", "ascending")])


def one_run(key: tuple, rows: pa.Table) -> pa.Table:
    """Several runs' parts of a shard as one."""
    found = pa.concat_tables([summed(part) for part in merged(rows)])
    return pa.Table.from_batches([run_row(key[0].as_py(), key[1].as_py(), key[2].as_py(), names_in(rows), found)])


def frequencies(runs: DataFrame, min_docs: int = MIN_DOCS, fan_in: int = FAN_IN) -> DataFrame:
    """(lang, shard, term, n, sources, counts) of the terms in at least ``min_docs`` documents of their language."""
    many = runs.agg(F.count_distinct("run")).first()[0]
    while many > fan_in:
        many = -(-many // fan_in)
        joint = F.pmod(F.xxhash64("run"), F.lit(many)).alias("joint")
        runs = staged(runs.groupBy("lang", "shard", joint).applyInArrow(one_run, RUN), "divergence-runs")

    def gather(key: tuple, rows: pa.Table) -> pa.Table:
        names, parts = pa.array(names_in(rows), pa.string()), []
        for postings in merged(rows):
            whole = postings.group_by("terms").aggregate([("docs", "sum")])
            often = whole.filter(pc.greater_equal(whole["docs_sum"], min_docs))["terms"]
            kept = summed(postings.filter(pc.is_in(postings["terms"], often.combine_chunks()))).combine_chunks()
            if not len(kept):
                continue
            terms, sources, n = (kept[c].chunk(0) for c in ("terms", "source", "n"))
            new = np.append(True, pc.not_equal(terms[1:], terms[:-1]).to_numpy(zero_copy_only=False))
            first = np.flatnonzero(new)
            offsets = pa.array(np.append(first, len(kept)), pa.int32())
            parts.append(pa.table({"term": terms.take(pa.array(first)).cast(pa.string()), "n": pa.array(np.add.reduceat(n.to_numpy(), first)),
                                   "sources": pa.ListArray.from_arrays(offsets, names.take(sources)), "counts": pa.ListArray.from_arrays(offsets, n)}))
        if not parts:
            return pa.schema([("lang", pa.string()), ("shard", pa.int32()), ("term", pa.string()), ("n", pa.int64()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))]).empty_table()
        out = pa.concat_tables(parts)
        return out.add_column(0, "lang", pa.array([key[0].as_py()] * len(out), pa.string())).add_column(1, "shard", pa.array([key[1].as_py()] * len(out), pa.int32()))

    schema = "lang string, shard int, term string, n long, sources array<string>, counts array<long>"
    return runs.groupBy("lang", "shard").applyInArrow(gather, schema)


def share(n: Column, whole: Column) -> Column:
    """1 + floor(SCALE (n + SMOOTH) / whole), in whole numbers."""
    return F.call_function("div", (n + SMOOTH).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)"), whole.cast("decimal(20,0)")) + 1


def shares(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """``share`` in a task: three decimal digits at a time, so that no product passes 64 bits while ``whole`` is under 2^53."""
    rest, out = counts + SMOOTH, np.zeros(np.broadcast(counts, whole).shape, np.int64)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + digits
    return out + 1


def corrections(freq: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) for a < b by number: the sum over terms that either has of |p_a - p_b| - |z_a - z_b|."""
    tiles = groups.select("lang", F.expr(f"seat div {TILE}").alias("tile")).distinct()
    pairs = tiles.join(tiles.withColumnRenamed("tile", "other"), "lang").where("tile <= other")
    shards = freq.select("lang", "shard").distinct().join(pairs, "lang")
    held = groups.withColumn("at", F.expr(f"seat div {TILE}"))
    sides = shards.join(held, "lang").where("at = tile OR at = other")
    sides = sides.select(*[F.col(c).alias(c) for c in ("lang", "shard", "tile", "other", "source", "seat", "whole")])
    rows = freq.join(pairs, "lang")

    def stream(key: tuple, terms: pa.Table, own: pa.Table) -> pa.Table:
        own = own.sort_by("seat")
        seats, whole = own["seat"].to_numpy(), own["whole"].to_numpy()
        place = {s: k for k, s in enumerate(own["source"].to_pylist())}
        first = np.flatnonzero(seats // TILE == key[2].as_py())
        second = np.flatnonzero(seats // TILE == key[3].as_py())
        zero = shares(np.zeros(len(seats), np.int64), whole)
        sums = np.zeros((len(first), len(second)), np.int64)
        apart = np.abs(zero[first][:, None] - zero[second][None, :])
        for at in range(0, len(terms), TERMS):
            part = terms.slice(at, TERMS).combine_chunks()
            lists = part["sources"].combine_chunks()
            names = [place.get(s, -1) for s in lists.flatten().to_pylist()]
            column, line = np.array(names, np.int64), np.repeat(np.arange(len(part)), lists.value_lengths().to_numpy(zero_copy_only=False))
            counts = part["counts"].combine_chunks().flatten().to_numpy()[column >= 0]
            line, column = line[column >= 0], column[column >= 0]
            grid = np.repeat(zero[None, :], len(part), axis=0)
            grid[line, column] = shares(counts, whole[column])
            right = grid[:, second]
            for k, a in enumerate(first):
                sums[k] += np.abs(right - grid[:, a : a + 1]).sum(axis=0)
            sums -= len(part) * apart
        a, b = np.repeat(seats[first], len(second)), np.tile(seats[second], len(first))
        kept = a < b
        return pa.table({"lang": pa.array([key[0].as_py()] * int(kept.sum()), pa.string()), "a": a[kept], "b": b[kept], "value": sums.ravel()[kept]})

    by = ["lang", "shard", "tile", "other"]
    found = rows.groupBy(*by).cogroup(sides.groupBy(*by)).applyInArrow(stream, "lang string, a long, b long, value long")
    return found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS, top: int = TOP, block: int = BLOCK, fan_in: int = FAN_IN) -> DataFrame:
    """Per group: its distance from each other source of the language, and its ``top`` terms beyond the language's share."""
    prepared_session(docs.sparkSession)
    read = docs.select(*[F.coalesce(col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    shards = -(-(read.agg(F.sum(F.octet_length("text"))).first()[0] or 1) // SHARD)
    runs = staged(runs_of(read, shards, block), "divergence-runs")
    freq = staged(frequencies(runs, min_docs, fan_in), "divergence-terms")

    held = freq.select("lang", "term", "n", F.explode(F.arrays_zip("sources", "counts")).alias("s"))
    held = held.select("lang", "term", "n", F.col("s.sources").alias("source"), F.col("s.counts").alias("own"))
    sizes = freq.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("all"))
    groups = read.select("lang", "source").distinct().join(held.groupBy("lang", "source").agg(F.sum("own").alias("own")), ["lang", "source"], "left")
    groups = groups.join(sizes, "lang", "left").na.fill(0, ["own", "v", "all"])
    seat = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1
    groups = staged(groups.select("lang", "source", seat.alias("seat"), "v", (F.col("own") + SMOOTH * F.col("v")).alias("whole"), (F.col("all") + SMOOTH * F.col("v")).alias("total")), "divergence-groups")

    zero = F.when(F.col("v") > 0, share(F.lit(0), F.greatest("whole", F.lit(1)))).otherwise(F.lit(0))
    a = groups.select("lang", "source", F.col("seat").alias("a"), zero.alias("za"), "v")
    b = groups.select("lang", F.col("source").alias("item"), F.col("seat").alias("b"), zero.alias("zb"))
    near = corrections(freq, groups.where("v > 0"))
    both = near.select("lang", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("ab"), "value").select("lang", "ab.*", "value")
    pair = a.join(b, "lang").where("a <> b").join(both, ["lang", "a", "b"], "left")
    pair = pair.select("lang", "source", F.lit("pair").alias("part"), "item", (F.col("v") * F.abs(F.col("za") - F.col("zb")) + F.coalesce("value", F.lit(0))).alias("value"))

    term = held.join(groups, ["lang", "source"]).withColumn("p", share(F.col("own"), F.col("whole"))).withColumn("q", share(F.col("n"), F.col("total")))
    term = term.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return pair.withColumn("rank", rank).unionByName(term.withColumn("rank", rank).where(F.col("rank") <= top))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


OP12_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents),
found AS (SELECT lang, source, id, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM found GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
own AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM found JOIN kept USING (lang, term) GROUP BY lang, source, term),
sizes AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
groups AS (
  SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN own USING (lang, source) GROUP BY lang, source),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n, 1 + (1000000000 * (coalesce(o.n, 0) + 5)) // (g.total + 5 * s.v) AS p,
         1 + (1000000000 * (k.n + 5)) // (s.total + 5 * s.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN sizes s USING (lang) LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
