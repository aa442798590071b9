import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from daybook.llm import merkle as M

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in row])


def climb(nodes):
    """All levels of the tree over ``nodes``."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def path(levels, at):
    out = []
    for level in levels[:-1]:
        out.append((at & 1, level[at ^ 1] if at ^ 1 < len(level) else None))
        at >>= 1
    return out


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    low = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        low[g] = climb([leaf(r) for r in groups[g]])
    high = climb([low[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for at, r in enumerate(groups[g]):
            steps = path(low[g], at) + path(high, k)
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            node = leaf((*r[:3], r[3] + 1, r[4])) if tampered else leaf(r)
            for left, other in steps:
                node = h(node) if other is None else h(other, node) if left else h(node, other)
            root = high[-1][0]
            out.append((r[0], leaf(r), low[g][-1][0], root, h(*[s for _, s in steps if s]), node, node == root))
    return out


def key(x):
    return (x[0] is not None, x[0] or 0, x[1:])


def result(spark, rows, every, extra=None):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if extra:
        df = df.withColumns(extra)
    changed = M.leaf_of([F.col(f) + 1 if f == "n_chars" else F.col(f) for f in M.FIELDS])
    keep = {"doc_id": F.col("doc_id"), "other": F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, changed)}
    found = M.manifest(df, M.FIELDS, "lang", "doc_id", keep, every)
    found = found.withColumn("end", M.folded(F.coalesce("other", "leaf"), F.col("proof")))
    return [(r.doc_id, r.leaf, r.subroot, r.root, h(*[s.sibling for s in r.proof if s.sibling]), r.end, r.end == r.root) for r in found.collect()]


ODD = [
    (None, None, None, None, None), (None, "s", "en", 3, "a"), (1, "s", "en", 3, ""), (1, "s", "en", 3, ""), (1, "t", "en", 3, "x" * 300_000),
    (2, "", "", 0, ""), (-5, "s", "é", None, "日本"), (7, "s", "en", 2**63 - 2, "y"), (9, "-", "=", 1, "2:ab"),
]


@pytest.mark.parametrize("every,n", [(1, 5), (2, 2), (2, 37), (3, 37), (8, 1)])
def test_against_the_definition(spark, every, n):
    rows = ODD + [(i, f"s{i % 3}", "de" if i % 4 else "en", i, f"text {i}") for i in range(10, 10 + n)]
    assert sorted(result(spark, rows, every), key=key) == sorted(plain(rows), key=key)


def test_many_groups(spark):
    rows = [(i, "s", f"l{i % 45}", i, "t") for i in range(70)]
    assert sorted(result(spark, rows, 2), key=key) == sorted(plain(rows), key=key)


def test_clashing_columns_and_empty(spark):
    extra = {"grp": F.lit(1), "pos": F.lit("p"), "digest": F.lit(0), "n": F.lit(2.0), "`proof`": F.lit(True)}
    assert sorted(result(spark, ODD, 2, extra), key=key) == sorted(plain(ODD), key=key)
    assert result(spark, [], 2) == []
    with pytest.raises(ValueError, match="pos"):
        M.manifest(spark.createDataFrame([], SCHEMA), M.FIELDS, "lang", "doc_id", {"Pos": F.lit(1)})


def test_interior_is_not_stored(spark):
    rows = [(i, "s", "en", i, "t") for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).select(F.lit("g").alias("grp"), F.col("doc_id").alias("key"), M.leaf_of([F.col("doc_id")]).alias("digest"))
    tree = M.build(M.placed(df, ["key"]).drop("key"), 3)
    assert [level.count() for level in tree.levels] == [300, 38, 5, 1]


def test_query(spark):
    from daybook.llm.registry import queries

    got = [tuple(r) for r in queries()["op11_merkle"](spark, SF).collect()]
    want = plain([tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*M.FIELDS).collect()])
    assert sorted(got) == sorted(want)
