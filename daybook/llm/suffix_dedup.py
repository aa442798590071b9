"""Removal of repeated byte strings by threshold-bounded interval expansion on a Burrows-Wheeler transform.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller id. All strings of that length are judged.

Cutting. Of a string's ``ANCHOR``-byte pieces the one with the least hash, the
leftmost of equals, is its anchor: equal strings have equal anchors. Runs of
neighbouring strings with the same anchor form one segment, about twenty
strings long, and go to the shard of the anchor's hash. Within a batch of text an equal
segment is sent once, for its least document; later documents' copies are
known to go whole and are sent along as spans. So a passage that stands in any
number of documents comes once a batch. Several neighbouring shards share a key of the
exchange, their rows in order of the shards, and the task that gets the key matches
one of them after the other: the text is moved once, however many shards there are.

Matching, shard by shard. Segments that share no anchor with ``SIDE`` bytes more on
either side with another one can share no string of ``LENGTH`` and are left out;
equal ones become one. The suffixes of the rest are sorted
(by prefix doubling, up to ``LENGTH`` bytes) for their transform. Then
intervals are extended backwards, breadth first: level l holds intervals of
strings of l bytes, their ends that have no common prefix value yet get
l, and only those are extended again. After level ``LENGTH`` - 1 the ends without a
value separate suffixes with ``LENGTH`` or more bytes in common, and an interval
between others is one string. It stops there, whatever the texts share beyond. The
least document of each interval decides which strings go.

Spans are joined to the texts by id; where ids repeat, by id and hash of the text.

Bounds: a task cuts ``CHUNK`` bytes at a time and sends what ``BATCH`` bytes
gave; shards grow with the input, at ``SHARD`` bytes of text each, and up to ``WIDTH``
of them have a key. Above ``FAN`` keys (about 60 GB of text) the pieces are moved in rounds.

Defined results: null text is empty; a text shorter than ``LENGTH`` loses nothing.
A null id is smaller than no other and larger than none: its document stays
whole and removes nothing. Documents with equal ids remove nothing from each
other, so repeated rows stay, or lose the same. Very long texts are cut in overlapping
chunks, which changes no string. An empty table gives none. The input's columns
are kept, and those that clash with a result's are replaced.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import carried, passing_shuffles, prepared_session, staged, table

LENGTH, ANCHOR = 50, 12
#: Of the LENGTH - ANCHOR bytes around an anchor, at least this many stand on one side of it.
SIDE = (LENGTH - ANCHOR + 1) // 2
CHUNK, BATCH, SHARD = 1 << 21, 10 << 20, 3 << 19
PIECE = "key long, batch long, piece binary"
SPAN = "doc_id long, tag long, start long, stop long"
RESULTS = ("removed", "kept")
#: A task sends pieces to so many keys at most; with more keys it takes several rounds. A key has so many shards at most, and
#: only one while there are less than a quarter of ``FAN``. A shard is hot at so many times the mean.
FAN, WIDTH, HOT = 4096, 10, 8
CODEC = pa.Codec("zstd", compression_level=1)
MIX = np.uint64(0x9E3779B97F4A7C15)


def loads(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one integer; ``text`` has eight spare bytes at its end."""
    return np.ndarray((len(text) - 8,), np.dtype("<u8"), text, strides=(1,))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    return x ^ (x >> np.uint64(29))


def anchors(text: np.ndarray) -> np.ndarray:
    """For each string of ``LENGTH`` bytes in ``text`` (eight spare bytes at its end): the place of its anchor."""
    n = len(text) - 8 - ANCHOR + 1
    eight = loads(text)
    h = mixed(mixed(eight[:n]) + eight[ANCHOR - 8 : ANCHOR - 8 + n])
    # upper bits: the hash; lower: the place, so that the leftmost of equals is least
    bits = np.uint64(max(1, int(n).bit_length()))
    key = (h >> bits << bits) | np.arange(n, dtype=np.uint64)
    width, have = LENGTH - ANCHOR + 1, 1
    while have < width:
        step = min(have, width - have)
        key = np.minimum(key[: len(key) - step], key[step:])
        have += step
    return (key & np.uint64((1 << int(bits)) - 1)).astype(np.int64)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of [start, start + size), one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def digests(text: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of each of many short ranges; ``text`` has eight spare bytes at its end."""
    eight, out = loads(text), mixed(sizes.astype(np.uint64))
    for at in range(0, int(sizes.max(initial=0)), 8):
        left = np.clip(sizes - at, 0, 8)
        mask = np.where(left >= 8, np.uint64(2**64 - 1), (np.uint64(1) << (left * 8).astype(np.uint64) % np.uint64(64)) - np.uint64(1))
        part = eight[np.minimum(starts + at, len(eight) - 1)] & mask
        out = np.where(left > 0, mixed(out + part), out)
    return out


def segments(text: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(part, start, size, anchor place) of the segments of the parts of ``text`` that end at ``stops``."""
    n = len(text) - 8 - LENGTH + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 4
    place = anchors(text)
    part = np.searchsorted(stops, np.arange(n), side="right")
    inside = np.arange(n) + LENGTH <= stops[part]
    new = np.ones(n, bool)
    new[1:] = (place[1:] != place[:-1]) | (part[1:] != part[:-1])
    first = np.flatnonzero(new & inside)
    last = np.flatnonzero(inside & np.append(new[1:] | ~inside[1:], True))
    return part[first], first, last - first + LENGTH, place[first]


def grouped(text: np.ndarray, start: np.ndarray, size: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of equal ranges: the row with the least document of each, and each row's class. Hashes only order them; bytes decide."""
    if not len(start):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    whole = digests(text, start, size)
    order = np.lexsort((doc, whole))
    a, b = order[:-1], order[1:]
    alike = (whole[a] == whole[b]) & (size[a] == size[b])
    pairs = np.flatnonzero(alike)
    for k in range(0, len(pairs), 1 << 16):
        p = pairs[k : k + (1 << 16)]
        equal = text[ranges(start[a[p]], size[a[p]])] == text[ranges(start[b[p]], size[b[p]])]
        alike[p] = np.logical_and.reduceat(equal, np.append(0, np.cumsum(size[a[p]])[:-1]))
    same = np.empty(len(order), np.int64)
    same[order] = np.append(0, np.cumsum(~alike))
    return order[np.append(True, ~alike)], same


def packed(*columns: np.ndarray) -> bytes:
    """Columns, each in the smallest type that holds it and compressed by itself, behind a head of nine bytes a column: many pieces are small."""
    small = [c if c.dtype == np.uint8 or c.min(initial=0) < 0 else c.astype(np.min_scalar_type(c.max(initial=0))) for c in columns]
    whole = [c.tobytes() for c in small]
    body = [min(w, CODEC.compress(w, asbytes=True), key=len) for w in whole]
    head = [struct.pack("<cII", c.dtype.char.encode(), len(w), len(z)) for c, w, z in zip(small, whole, body)]
    return b"".join((bytes([len(columns)]), *head, *body))


def opened(piece: pa.Buffer) -> list[np.ndarray]:
    """The columns of a piece in their small types."""
    n, out = memoryview(piece)[0], []
    at = 1 + 9 * n
    for kind, whole, size in struct.iter_unpack("<cII", memoryview(piece)[1:at]):
        body = piece.slice(at, size)
        out.append(np.frombuffer(body if size == whole else CODEC.decompress(body, whole), np.dtype(kind.decode())))
        at += size
    return out


def parts(columns: list[np.ndarray]) -> list[list[np.ndarray]]:
    """A piece's columns for each shard of its key."""
    *rows, segment, size, offset, counts, text = columns
    ends = np.cumsum(counts, dtype=np.int64)
    # up to these places in the rows, the segments and the text
    upto = np.append(0, np.where(ends > 0, segment[ends - 1].astype(np.int64) + 1, 0))
    places = np.append(0, np.cumsum(size, dtype=np.int64))[upto]
    row = [slice(a, b) for a, b in zip(np.append(0, ends[:-1]), ends)]
    return [
        [*[c[r] for c in rows], segment[r].astype(np.int64) - a, size[a:b], offset[a:b], text[x:y]]
        for r, a, b, x, y in zip(row, upto, upto[1:], places, places[1:])
    ]


class Segments:
    """Segments with their documents and places: from texts that are cut, or from pieces that arrive."""

    def __init__(self):
        self.rows: list[tuple[np.ndarray, ...]] = []
        self.texts: list[np.ndarray] = []
        self.size = 0

    def add(self, ids: np.ndarray, tags: np.ndarray, begin: np.ndarray, start: np.ndarray, size: np.ndarray, offset: np.ndarray, text: np.ndarray) -> None:
        self.rows.append((ids, tags, begin, start + self.size, size, offset))
        self.texts.append(text)
        self.size += len(text)

    def cut(self, texts: list[np.ndarray], ids: list[int], tags: list[int], begins: list[int]) -> None:
        """The segments of texts or chunks of them, and where these begin."""
        text = np.concatenate([*texts, np.zeros(8, np.uint8)])
        stops = np.cumsum([len(t) for t in texts])
        part, start, size, anchor = segments(text, stops)
        begin = np.array(begins, np.int64)[part] + start - (stops - [len(t) for t in texts])[part]
        self.add(np.array(ids, np.int64)[part], np.array(tags, np.int64)[part], begin, start, size, anchor - start, text[:-8])

    def arrive(self, *columns: np.ndarray) -> None:
        ids, tags, begin, segment, size, offset = (c.astype(np.int64) for c in columns[:-1])
        text, start = columns[-1], np.cumsum(size) - size
        self.add(ids, tags, begin, start[segment], size[segment], offset[segment], text)

    def clear(self) -> None:
        self.rows, self.texts = [], []

    def all(self) -> tuple[np.ndarray, ...]:
        """(ids, tags, begin, start, size, offset) and the text, with eight spare bytes."""
        columns = [np.concatenate(c) if c else np.empty(0, np.int64) for c in (zip(*self.rows) if self.rows else [()] * 6)]
        return *columns, np.concatenate([*self.texts, np.zeros(8, np.uint8)])


def shard_of(text: np.ndarray, start: np.ndarray, offset: np.ndarray, shards: int) -> np.ndarray:
    return ((digests(text, start + offset, np.full(len(start), ANCHOR)) >> np.uint64(13)) % np.uint64(shards)).astype(np.int64)


def joined(ids: np.ndarray, tags: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans (ids, tags, start, stop), those that touch within a document joined."""
    order = np.lexsort((begin, tags, ids))
    ids, tags, begin, stop = ids[order], tags[order], begin[order], (begin + size)[order]
    if not len(ids):
        return ids, tags, begin, stop
    new = np.append(True, (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1]))
    # places grow by a step from one document to the next, so that the furthest end so far is that of the document
    step = (np.cumsum(new) - 1) * (int(stop.max()) + 1)
    far = np.maximum.accumulate(stop + step)
    new[1:] |= begin[1:] + step[1:] > far[:-1]
    first = np.flatnonzero(new)
    return ids[first], tags[first], begin[first], np.maximum.reduceat(stop + step, first) - step[first]


def sent(held: Segments, batch: int, shards: int, width: int, hot: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """Pieces (key, batch, bytes): each segment once, for its least document, to the key of its shard; and later documents' copies as spans.

    A key has ``width`` shards. Where these are few enough to be matched in one task, a piece has its rows by shard and their numbers."""
    ids, tags, begin, start, size, offset, text = held.all()
    if not len(ids):
        return
    shard = shard_of(text, start, offset, shards)
    if len(hot):
        # a hot shard's strings go one by one, each by all its bytes
        one = np.isin(shard, hot) & (size >= LENGTH)
        many = size[one] - LENGTH + 1
        step = ranges(np.zeros(len(many), np.int64), many)
        back = lambda c, by: np.concatenate((c[~one], np.repeat(c[one], many) + by))
        ids, tags, begin, start, offset, size = back(ids, 0), back(tags, 0), back(begin, step), back(start, step), back(offset, -step), np.append(size[~one], np.full(len(step), LENGTH))
        windows = digests(text, start[len(shard) - one.sum() :], np.full(len(step), LENGTH)) >> np.uint64(13)
        shard = np.append(shard[~one], (windows % np.uint64(shards)).astype(np.int64))
    first, same = grouped(text, start, size, ids)
    copies = ids > ids[first[same]]
    if copies.any():
        yield batch % shards // width, batch, packed(*joined(ids[copies], tags[copies], begin[copies], size[copies]))
    own = np.flatnonzero(~copies)
    own = own[np.lexsort((same[own], shard[own]))]
    key = shard[own] // width
    cuts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    for a, b in zip(cuts, [*cuts[1:], len(own)]):
        rows = own[a:b]
        new = np.append(True, same[rows][1:] != same[rows][:-1])
        f = rows[new]
        counts = np.bincount(shard[rows] - key[a] * width, minlength=width) if width <= WIDTH else np.empty(0, np.int64)
        yield int(key[a]), batch, packed(ids[rows], tags[rows], begin[rows], np.cumsum(new) - 1, size[f], offset[f], counts, text[ranges(start[f], size[f])])


def batches_of(rows: Iterator[pa.RecordBatch]) -> Iterator[Segments]:
    """Segments of about ``BATCH`` bytes of text after another, cut ``CHUNK`` bytes at a time."""
    held, texts, ids, tags, begins, size = Segments(), [], [], [], [], 0
    for batch in rows:
        for doc, tag, value in zip(batch["doc_id"].to_pylist(), batch["tag"].to_pylist(), batch["text"].cast(pa.binary())):
            text = np.frombuffer(value.as_buffer(), np.uint8)
            for at in range(0, len(text) - LENGTH + 1, CHUNK - LENGTH + 1):
                texts.append(text[at : at + CHUNK])
                ids.append(doc)
                tags.append(tag)
                begins.append(at)
                size += len(texts[-1])
                if size >= CHUNK:
                    held.cut(texts, ids, tags, begins)
                    texts, ids, tags, begins, size = [], [], [], [], 0
                if held.size >= BATCH:
                    yield held
                    held = Segments()
    if texts:
        held.cut(texts, ids, tags, begins)
    if held.size:
        yield held


def pieces_table(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    key, batch, piece = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(batch, pa.int64()), pa.array(piece, pa.binary())], names=["key", "batch", "piece"])


def suffix_order(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places of ``text``, whose segments end with a 0 at ``ends``, by their first ``LENGTH`` bytes up to that end, by prefix doubling."""
    n = len(text)
    place, key, have = np.arange(n, dtype=np.int32), np.zeros(n, np.int64), 7
    for step in range(have):
        at = np.minimum(place + step, n - 1)
        key = key << 9 | np.where(place + step <= ends, text[at], 0)
    rank = np.empty(n, np.int32)
    while True:
        order = np.argsort(key).astype(np.int32)  # equal ones in any order: they have the same class
        if have >= LENGTH:
            return order
        ranked = key[order]
        rank[order] = np.cumsum(np.append(True, ranked[1:] != ranked[:-1]), dtype=np.int32)
        # ranks may overlap: those of ``have`` bytes here and ``step`` further on give ``have + step`` bytes
        step = min(have, LENGTH - have)
        np.multiply(rank, n + 1, out=key, dtype=np.int64)
        key += np.where(place + step <= ends, rank[np.minimum(place + step, n - 1)], 0)
        have += step


def intervals(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Class of each place of ``order``: neighbours in a class have ``LENGTH`` or more bytes in common.

    ``before`` is the Burrows-Wheeler transform. ``follow`` leads a place to that of the suffix
    one byte longer; ``prior`` and ``after`` are the places with the same byte before and behind it.
    """
    n = len(order)
    before = text[order - 1]
    by = np.argsort(before, kind="stable").astype(np.int32)
    follow = np.empty(n, np.int32)
    follow[by] = np.arange(n, dtype=np.int32)
    joint = before[by[1:]] == before[by[:-1]]
    after, prior = np.full(n, n, np.int32), np.full(n, -1, np.int32)
    after[by[:-1][joint]] = by[1:][joint]
    prior[by[1:][joint]] = by[:-1][joint]
    common = np.full(n + 1, -1, np.int8)
    common[0] = common[n] = 0
    leading = text[order]
    low = np.flatnonzero(np.append(True, leading[1:] != leading[:-1]))
    high = np.append(low[1:], n)
    for level in range(LENGTH):
        # intervals of strings of level + 1 bytes; an end without a value has ``level`` bytes in common
        fresh = common[high] < 0
        low, high = low[fresh], high[fresh]
        common[high] = level
        if not len(low) or level == LENGTH - 1:
            break
        place = ranges(low, high - low)
        lower, upper = np.repeat(low, high - low), np.repeat(high, high - low)
        real = before[place] > 0
        place, lower, upper = place[real], lower[real], upper[real]
        low = np.sort(follow[place[prior[place] < lower]]).astype(np.int64)
        high = np.sort(follow[place[after[place] >= upper]]).astype(np.int64) + 1
    return np.cumsum(common[:n] >= 0, dtype=np.int32) - 1


def shared_sides(ids: np.ndarray, start: np.ndarray, size: np.ndarray, offset: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Rows whose anchor with ``SIDE`` bytes behind it, or before it, another document's row has too."""
    right, left = np.flatnonzero(offset + ANCHOR + SIDE <= size), np.flatnonzero(offset >= SIDE)
    whole = lambda at: digests(text, at, np.full(len(at), ANCHOR + SIDE))
    key = np.concatenate((whole((start + offset)[right]), ~whole((start + offset - SIDE)[left])))
    row = np.concatenate((right, left))
    order = np.argsort(key)
    key, row = key[order], row[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
    found = np.zeros(len(ids), bool)
    if len(first):
        doc = ids[row]
        several = np.minimum.reduceat(doc, first) < np.maximum.reduceat(doc, first)
        found[row[np.repeat(several, np.diff(np.append(first, len(key))))]] = True
    return found


def matched(held: Segments) -> tuple[np.ndarray, ...]:
    """Spans (ids, tags, start, stop) to remove, from all segments of a shard; they may overlap."""
    spans = []
    ids, tags, begin, start, size, offset, text = held.all()
    held.clear()
    near = shared_sides(ids, start, size, offset, text)
    ids, tags, begin, start, size = ids[near], tags[near], begin[near], start[near], size[near]
    first, same = grouped(text, start, size, ids)
    if len(first):
        copies = ids > ids[first[same]]
        spans.append((ids[copies], tags[copies], begin[copies], (begin + size)[copies]))
        # the different segments, each with a 0 behind it
        sizes = size[first]
        stops = np.cumsum(sizes + 1) - 1
        whole = np.zeros(int(stops[-1]) + 1, np.uint16)
        own = ranges(stops - sizes, sizes)
        whole[own] = text[ranges(start[first], sizes)].astype(np.uint16) + 1
        ends = np.repeat(stops.astype(np.int32), sizes + 1)
        order = suffix_order(whole, ends)
        label = intervals(whole, order)
        # documents by their place among all ids of the shard
        doc = np.repeat(np.unique(ids[first], return_inverse=True)[1].astype(np.int32), sizes + 1)[order]
        full = (ends - np.arange(len(whole), dtype=np.int32) >= LENGTH)[order]
        doc_of = np.where(full, doc, np.iinfo(np.int32).max)
        least = np.minimum.reduceat(doc_of, np.flatnonzero(np.append(True, label[1:] != label[:-1])))[label]
        gone = np.zeros(len(whole) + 1, bool)
        gone[order] = full & (least < doc)
        # runs of strings that go, in places of the segment; then in those of each document that is its least
        a = np.flatnonzero(gone[1:] & ~gone[:-1]) + 1
        a = np.append(0, a) if gone[0] else a
        b = np.flatnonzero(gone[:-1] & ~gone[1:]) + LENGTH
        of = np.searchsorted(stops, a)
        keep = np.flatnonzero(~copies)
        count, at = np.bincount(of, minlength=len(first)), np.searchsorted(of, np.arange(len(first)))
        rows, runs = np.repeat(keep, count[same[keep]]), ranges(at[same[keep]], count[same[keep]])
        shift = begin[rows] - (stops - sizes)[same[rows]]
        spans.append((ids[rows], tags[rows], a[runs] + shift, b[runs] + shift))
    return whole_spans(spans)


def whole_spans(spans: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Spans from several places in one, those that touch joined."""
    if not spans:
        return (np.empty(0, np.int64),) * 4
    ids, tags, a, b = (np.concatenate(c).astype(np.int64) for c in zip(*spans))
    return joined(ids, tags, a, b - a)


def matched_key(pieces: list[pa.Buffer], width: int) -> tuple[np.ndarray, ...]:
    """Spans to remove from all pieces of a key, matched shard by shard."""
    found = [opened(p) for p in pieces]
    spans = [tuple(c) for c in found if len(c) == 4]
    shards = [parts(c) for c in found if len(c) > 4]
    del found
    for k in range(width):
        held = Segments()
        for of in shards:
            held.arrive(*of[k])
            of[k] = None
        if held.size:
            spans.append(matched(held))
    return whole_spans(spans)


def spans_of(docs: DataFrame, shard_bytes: int = SHARD, fan: int = FAN) -> DataFrame:
    """(doc_id, tag, start, stop) of what goes from ``docs`` (doc_id, tag, text); spans of a document may overlap."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // shard_bytes))
    widths = [min(WIDTH, -(-shards // max(1, fan // 4)))]
    while shards / widths[0] > fan:
        widths.insert(0, widths[0] * fan)

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in batches_of(rows):
            _, _, _, start, _, offset, text = held.all()
            shard, n = np.unique(shard_of(text, start, offset, shards), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), pa.array(n, pa.int64())], names=["shard", "n"])

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = TaskContext.get().partitionId() << 24
        for k, held in enumerate(batches_of(rows)):
            if made := list(sent(held, batch + k, shards, widths[0], hot)):
                yield pieces_table(made)

    def divide(width: int):
        def run(key: tuple, rows: pa.Table) -> pa.Table:
            held, out = Segments(), []
            for batch, piece in zip(rows["batch"].to_pylist(), rows["piece"]):
                columns = opened(piece.as_buffer())
                if len(columns) == 4:
                    out.append((batch % shards // width, batch, piece.as_py()))
                else:
                    held.arrive(*columns[:6], columns[-1])
            out += sent(held, rows["batch"][0].as_py(), shards, width, hot)
            return pa.Table.from_batches([pieces_table(out)])

        return run

    def match(key: tuple, rows: pa.Table) -> pa.Table:
        found = matched_key([p.as_buffer() for p in rows["piece"]], widths[-1])
        return pa.table(dict(zip(["doc_id", "tag", "start", "stop"], found)))

    counted = staged(docs.mapInArrow(count, "shard long, n long").groupBy("shard").agg(F.sum("n").alias("n")), "repeats-shards")
    total = counted.agg(F.sum("n")).first()[0] or 0
    hot = np.array([r.shard for r in counted.where(F.col("n") > HOT * total / shards).collect()], np.int64)
    pieces = docs.mapInArrow(cut, PIECE)
    for width in widths[1:]:
        joint = F.pmod("batch", F.lit(max(1, size // BATCH // fan)))
        pieces = pieces.groupBy("key", joint.alias("joint")).applyInArrow(divide(width), PIECE)
    return pieces.groupBy("key").applyInArrow(match, SPAN)


def without(texts: pd.Series, starts: pd.Series, stops: pd.Series) -> pd.DataFrame:
    """Texts less their spans, and the spans joined; null for a text without spans."""
    kept, removed = [], []
    for text, a, b in zip(texts, starts, stops):
        if text is None:
            kept.append(None)
            removed.append(None)
            continue
        zero = np.zeros(len(a), np.int64)
        _, _, a, b = joined(zero, zero, np.asarray(a), np.asarray(b) - np.asarray(a))
        data = text.encode("utf-8", "surrogatepass")
        edges = [0, *np.column_stack((a, b)).ravel().tolist(), len(data)]
        kept.append(b"".join(data[x:y] for x, y in zip(edges[::2], edges[1::2])))
        removed.append([{"start": x, "stop": y} for x, y in zip(a.tolist(), b.tolist())])
    return pd.DataFrame({"kept": kept, "removed": removed})


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_bytes: int = SHARD, fan: int = FAN) -> DataFrame:
    """``docs`` with ``kept``, the bytes that stay, and ``removed``, the joined spans of bytes that go."""
    prepared_session(docs.sparkSession)
    read = carried(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text", F.coalesce("text", F.lit("")))
    again = read.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty()
    tagged = read.withColumn("tag", F.lit(0).cast("long") if again else F.xxhash64("text"))
    with passing_shuffles(docs.sparkSession):
        spans = staged(spans_of(tagged.where("doc_id IS NOT NULL").select("doc_id", "tag", "text"), shard_bytes, fan), "repeats-spans")
    spans = spans.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    both = tagged.join(spans, ["doc_id", "tag"], "left")
    cutter = F.pandas_udf(without, "kept binary, removed array<struct<start:long,stop:long>>")
    touched = F.when(F.col("spans").isNotNull(), F.col("text"))
    cut = both.select("row", "text", cutter(touched, F.col("spans.start"), F.col("spans.stop")).alias("cut"))
    own = [c for c in docs.columns if c.lower() not in RESULTS]
    inner = [F.col("row").getField(c).alias(c) for c in own]
    none = F.array().cast("array<struct<start:long,stop:long>>")
    return cut.select(*inner, F.coalesce("cut.kept", F.col("text").cast("binary")).alias("kept"), F.coalesce("cut.removed", none).alias("removed"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s.stop - s.start)
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    out = out.select("doc_id", n_bytes.alias("n_bytes"), gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
    with passing_shuffles(spark):  # the texts were shuffled to their spans; the rows are short
        return staged(out, "repeats-result")


OP13_SQL = """
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
pieces AS (SELECT id, doc_id, length(h) // 2 AS n, 256 * k AS base, substr(h, 512 * k + 1, 610) AS piece
           FROM (SELECT *, unnest(range(0, (length(h) // 2 + 255) // 256)) AS k FROM docs)),
strings AS (SELECT id, doc_id, base + j AS i, substr(piece, 2 * j + 1, 100) AS s
            FROM (SELECT *, unnest(range(0, least(256, n - base - 49))) AS j FROM pieces)),
firsts AS (SELECT s, min(doc_id) AS first_id FROM strings GROUP BY s HAVING count(*) > 1),
gone AS (SELECT id, i FROM strings JOIN firsts USING (s) WHERE first_id < doc_id),
runs AS (SELECT id, i, sum(CASE WHEN i - before <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY i) AS run
         FROM (SELECT *, lag(i) OVER (PARTITION BY id ORDER BY i) AS before FROM gone)),
spans AS (SELECT id, min(i) AS a, max(i) + 50 AS b FROM runs GROUP BY id, run),
parts AS (SELECT s.*, substr(h, 2 * coalesce(lag(b) OVER (PARTITION BY id ORDER BY a), 0) + 1,
                             2 * (a - coalesce(lag(b) OVER (PARTITION BY id ORDER BY a), 0))) AS kept FROM spans s JOIN docs USING (id)),
sums AS (SELECT id, string_agg(kept, '' ORDER BY a) AS kept, max(b) AS last_b, sum(b - a) AS n_removed, count(*) AS n_spans FROM parts GROUP BY id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept || substr(h, 2 * last_b + 1), h))) AS kept_sha256
FROM docs LEFT JOIN sums USING (id)
"""
