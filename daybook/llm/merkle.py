"""Merkle manifest of a data set, with proofs by checkpoint and recompute.

Every row is a leaf. Within a group leaves stand in key order; while several
nodes remain, each two consecutive ones (a last one alone) become the SHA-256
of their hex digests, up to the group's subroot. Subroots, in group order,
are the leaves of the top tree.

Only every ``every``-th level is stored (``build``): a stored node is the root
of an aligned subtree of 2^every nodes of the stored level below. ``proofs``
goes down again: a subtree's interior is computed anew from its stored
nodes, the siblings of each of them are put before those of the subtree's
root, and the interior is dropped. A proof is the siblings from the leaf up,
each with the side it stands on; a node without one is hashed alone and has a
null there.

Positions come from one range-partitioned sort by (group, key, leaf): each
part's rows are numbered where they lie and moved by the number of the
group's rows in earlier parts. So a group of any size is spread over all parts, and
no task holds more than a subtree: 2^every nodes and one proof.

Defined results: a null field is ``-``, so it differs from an empty text
(``0:``). A null group is one of its own, before all others; null keys come
first. Repeated keys are ordered by their leaf digest; equal leaves have
equal digests at places of their own. Very long texts are hashed whole by
Spark's ``sha2``. An empty table has no rows, no subroots and no root. Other
columns are not read unless asked for with ``keep``; a kept one whose name
clashes with a result's is an error.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.llm.common import col, prepared_session, staged, table

EVERY = 8
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
PROOF = "array<struct<sibling:string,left:boolean>>"
STEP = pa.struct([("sibling", pa.string()), ("left", pa.bool_())])
RESULTS = ["grp", "pos", "leaf", "proof", "subroot", "root"]


def leaf_of(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each ``-`` if null, else its UTF-8 byte count, ``:``, its text."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def parent(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def interior(nodes: list[str], n: int, every: int) -> list[list[str]]:
    """Levels of an aligned subtree below its root, from its stored nodes up, and the root last.

    ``n``: the group's nodes on the stored level. A subtree that is the whole level ends with one node;
    one of several rises ``every`` levels, its last node alone if need be.
    """
    levels, whole = [nodes], n <= 1 << every
    while len(levels) <= every and not (whole and len(levels[-1]) == 1):
        below = levels[-1]
        levels.append([parent(below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def siblings(levels: list[list[str]], at: int) -> list[tuple[str | None, bool]]:
    """Sibling and side on each level below the root, for the node at place ``at`` of the lowest."""
    out = []
    for level in levels[:-1]:
        other = at ^ 1
        out.append((level[other], bool(at & 1)) if other < len(level) else (None, False))
        at >>= 1
    return out


@dataclass
class Tree:
    """Stored levels from the leaves up, each (grp, pos, n, digest); the last has one node a group."""

    levels: list[DataFrame]
    every: int

    @property
    def roots(self) -> DataFrame:
        return self.levels[-1].select("grp", "digest")


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, the place within ``grp`` by ``order``, from 0, and ``n``, the group's size."""
    by = ["grp", *order]
    spread = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    # the id's upper bits are the part, its lower 33 the row's number in the part
    spread = staged(spread.withColumn("seat", F.monotonically_increasing_id()), "merkle-leaves")
    part = F.shiftright("seat", 33)
    held = spread.groupBy("grp", part.alias("part")).agg(F.count("*").alias("held"), F.min("seat").alias("first"))
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    moved = held.select(
        "grp", "part", "first",
        F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"),
        F.sum("held").over(Window.partitionBy("grp")).alias("n"),
    )
    out = spread.withColumn("part", part).join(moved, ["grp", "part"])
    return out.withColumn("pos", F.col("seat") - F.col("first") + F.col("before")).drop("part", "seat", "first", "before")


def build(leaves: DataFrame, every: int = EVERY) -> Tree:
    """The tree over ``leaves`` (grp, pos, n, digest): every ``every``-th level, written one after the other."""

    def rise(key: tuple, rows: pa.Table) -> pa.Table:
        at = rows.sort_by("pos")
        n = at["n"][0].as_py()
        top = interior(at["digest"].to_pylist(), n, every)[-1][0]
        return pa.table({"grp": at["grp"][:1].combine_chunks(), "pos": pa.array([at["pos"][0].as_py() >> every], pa.int64()),
                         "n": pa.array([(n + (1 << every) - 1) >> every], pa.int64()), "digest": [top]})

    levels = [leaves]
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        below = levels[-1].select("grp", "pos", "n", "digest", F.shiftright("pos", every).alias("block"))
        up = below.groupBy("grp", "block").applyInArrow(rise, "grp string, pos long, n long, digest string")
        levels.append(staged(up, "merkle-level"))
        most = (most + (1 << every) - 1) >> every
    return Tree(levels, every)


def proofs(tree: Tree, above: DataFrame, keep: list[str]) -> DataFrame:
    """(grp, pos, proof) of every leaf and its ``keep`` columns; ``above`` (grp, proof) is what follows a group's subroot."""
    every = tree.every

    def down(names: list[str]):
        def run(nodes: pa.Table, tops: pa.Table) -> pa.Table:
            nodes = nodes.sort_by("pos")
            levels = interior(nodes["digest"].to_pylist(), nodes["n"][0].as_py(), every)
            rest = tops["proof"].combine_chunks().flatten()
            steps = [siblings(levels, at) for at in range(len(levels[0]))]
            flat = [s for own in steps for s in own]
            own = pa.StructArray.from_arrays([pa.array([s for s, _ in flat], pa.string()), pa.array([b for _, b in flat], pa.bool_())], fields=list(STEP))
            # every node's own steps, then the subtree's: places in (own + rest)
            size, place = len(levels) - 1, []
            for at in range(len(steps)):
                place += range(at * size, (at + 1) * size)
                place += range(len(flat), len(flat) + len(rest))
            both = pa.concat_arrays([own, rest.cast(STEP)]).take(pa.array(place, pa.int64()))
            step = size + len(rest)
            offsets = pa.array(range(0, step * len(steps) + 1, step) if step else [0] * (len(steps) + 1), pa.int32())
            return nodes.select(names).append_column("proof", pa.ListArray.from_arrays(offsets, both))

        return run

    path = above.select("grp", F.lit(0).cast("long").alias("block"), "proof")
    for k in range(len(tree.levels) - 2, -1, -1):
        names = ["grp", "pos"] if k else ["grp", "pos", *keep]
        nodes = tree.levels[k].withColumn("block", F.shiftright("pos", every))
        types = {f.name: f.dataType.simpleString() for f in nodes.schema.fields}
        schema = ", ".join(f"{n} {types[n]}" for n in names) + f", proof {PROOF}"
        found = nodes.groupBy("grp", "block").cogroup(path.groupBy("grp", "block")).applyInArrow(down(names), schema)
        if not k:
            return found
        path = staged(found, "merkle-paths").withColumnRenamed("pos", "block")
    return tree.levels[0].join(path.drop("block"), "grp").select("grp", "pos", *keep, "proof")


def manifest(docs: DataFrame, fields: list[str], group: str, key: str, keep: dict[str, Column] | None = None, every: int = EVERY) -> DataFrame:
    """Leaf, subroot, root and proof of every row of ``docs``, with the columns of ``keep``."""
    prepared_session(docs.sparkSession)
    keep = keep or {}
    if clash := {k.lower() for k in keep} & {*RESULTS, "n", "digest", "block", "key", "proof"}:
        raise ValueError(f"kept columns clash with results: {sorted(clash)}")
    # a null group sorts before '=' and any name
    grp = F.coalesce(F.concat(F.lit("="), col(group).cast("string")), F.lit(""))
    rows = docs.select(grp.alias("grp"), col(key).alias("key"), leaf_of([col(f) for f in fields]).alias("digest"), *[c.alias(k) for k, c in keep.items()])
    lower = build(placed(rows, ["key", "digest"]).drop("key"), every)
    subroots = lower.roots.select(F.lit("").alias("grp"), F.col("grp").alias("member"), "digest")
    upper = build(placed(subroots, ["member"]), every)
    ends = upper.roots.select(F.lit("").alias("grp"), F.array().cast(PROOF).alias("proof"))
    tops = proofs(upper, ends, ["member", "digest"])
    above = tops.select(F.col("member").alias("grp"), "proof")
    named = tops.select("grp", F.col("member"), F.col("digest").alias("subroot"))
    roots = named.join(upper.roots.withColumnRenamed("digest", "root"), "grp").drop("grp").withColumnRenamed("member", "grp")
    found = proofs(lower, above, [*keep, "digest"]).withColumnRenamed("digest", "leaf")
    return found.join(roots, "grp").select(*keep, *RESULTS)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, leaf, lambda node, step: F.sha2(
        F.when(step.sibling.isNull(), node).when(step.left, F.concat(step.sibling, node)).otherwise(F.concat(node, step.sibling)), 256))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    other = leaf_of([F.col(f).cast("decimal(20,0)") + 1 if f == "n_chars" else F.col(f) for f in FIELDS])
    found = manifest(docs, FIELDS, "lang", "doc_id", {"doc_id": F.col("doc_id"), "altered": F.when(tampered, other)})
    out = found.withColumn("folded_root", folded(F.coalesce("altered", "leaf"), F.col("proof")))
    sibs = F.concat_ws("", F.transform("proof", lambda s: s.sibling))
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(sibs, 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


OP11_SQL = """
WITH RECURSIVE ids AS (
  SELECT *, row_number() OVER () AS id, coalesce('=' || lang, '') AS grp,
         list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
             lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc
  FROM documents),
fields AS (
  SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
              || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS tail,
         n_chars + CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN 1 ELSE 0 END AS changed
  FROM ids),
leaves AS (
  SELECT id, doc_id, grp, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
         sha256(head || coalesce(strlen(changed::VARCHAR) || ':' || changed, '-') || tail) AS altered
  FROM fields),
seats AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
low AS (
  SELECT grp, 0 AS level, pos, leaf AS digest, count(*) OVER (PARTITION BY grp) AS n FROM seats
  UNION ALL
  SELECT grp, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM low WHERE n > 1
  GROUP BY grp, level, pos // 2),
tops AS (SELECT grp, digest AS subroot, row_number() OVER (ORDER BY grp) - 1 AS seat, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, seat AS pos, subroot AS digest, n FROM tops
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM high WHERE n > 1
  GROUP BY level, pos // 2),
steps AS (
  SELECT s.id, a.level AS step, b.digest AS sib, a.pos % 2 = 1 AS is_left
  FROM seats s JOIN low a ON a.grp = s.grp AND a.pos = s.pos >> a.level AND a.n > 1
  LEFT JOIN low b ON b.grp = a.grp AND b.level = a.level AND b.pos = xor(a.pos, 1)
  UNION ALL
  SELECT s.id, 100 + a.level, b.digest, a.pos % 2 = 1
  FROM seats s JOIN tops t USING (grp) JOIN high a ON a.pos = t.seat >> a.level AND a.n > 1
  LEFT JOIN high b ON b.level = a.level AND b.pos = xor(a.pos, 1)),
proofs AS (
  SELECT id, string_agg(sib, '' ORDER BY step) AS sibs, list({'d': sib, 'l': is_left} ORDER BY step) AS path FROM steps GROUP BY id),
ends AS (
  SELECT doc_id, leaf, subroot, (SELECT digest FROM high WHERE n = 1) AS root, sha256(coalesce(sibs, '')) AS proof_sha256,
         list_reduce(list_prepend({'d': altered, 'l': false}, coalesce(path, [])),
           lambda node, step: {'d': sha256(CASE WHEN step.d IS NULL THEN node.d WHEN step.l THEN step.d || node.d ELSE node.d || step.d END),
                               'l': false}).d AS folded_root
  FROM seats JOIN tops USING (grp) LEFT JOIN proofs USING (id))
SELECT *, folded_root = root AS verified FROM ends
"""
