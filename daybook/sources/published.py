"""Published data sets: dated folders that are whole or not there (SNK-1, SRC-4).

    <base>/2020-08-23T22-51-07/<split>/part-*    the rows of a split
    <base>/2020-08-23T22-51-07/_manifest/        one line of JSON, written last

The manifest names every file with its size and gives each split's rows and a
sum over their hashes, observed by the write itself. A reader takes no
folder without a manifest, or whose files are others than it names; ``verify``
reads the rows as well and compares counts and sums. A writer that dies leaves a
folder without a manifest, which no reader sees and ``latest`` passes over.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daybook.sources.examples import _save, to_export

#: Sums of 64-bit hashes are taken modulo a prime, so that none overflows whatever the number of rows.
MODULUS = (1 << 31) - 1


class Incomplete(ValueError):
    """A folder that is no whole published data set."""


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def files_of(spark: SparkSession, path: str) -> dict[str, int]:
    """Data files under a folder, by name, with their sizes."""
    fs, root = _folder(spark, path)
    if not fs.exists(root):
        return {}
    found, entries = {}, fs.listFiles(root, True)
    start = len(fs.makeQualified(root).toString()) + 1
    while entries.hasNext():
        status = entries.next()
        name = status.getPath().toString()[start:]
        if not any(part.startswith(("_", ".")) for part in name.split("/")):
            found[name] = status.getLen()
    return found


def row_sum(columns: list[str]) -> Column:
    """A sum over rows that doesn't depend on their order."""
    return F.coalesce(F.sum(F.pmod(F.xxhash64(*columns), F.lit(MODULUS))), F.lit(0))


def stamp(when: dt.datetime) -> str:
    return when.strftime("%Y-%m-%dT%H-%M-%S")


@contextmanager
def open_files(spark: SparkSession, n: int) -> Iterator[None]:
    """Writes by split in this block keep ``n`` files open in a task, so that no rows are sorted by split."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, "0")
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def publish(df: DataFrame, base: str, when: dt.datetime, splits: list[str], fmt: str = "parquet", compression: str = "snappy") -> str:
    """Write the examples of ``df`` (with ``split``) as a new data set of ``base``; its folder.

    The export is one pass over ``df``; a second publication at the same time is refused."""
    spark = df.sparkSession
    path = f"{base.rstrip('/')}/{stamp(when)}"
    fs, root = _folder(spark, path)
    if fs.exists(root):
        raise FileExistsError(path)
    out = to_export(df, ["split"]).where(F.col("split").isin(splits))
    columns = [c for c in out.columns if c != "split"]
    seen = Observation("published")
    here = lambda s: F.col("split") == s
    hashed = F.pmod(F.xxhash64(*columns), F.lit(MODULUS))
    counters = [x for s in splits for x in (F.count_if(here(s)).alias(f"{s}.rows"), F.coalesce(F.sum(F.when(here(s), hashed)), F.lit(0)).alias(f"{s}.sum"))]
    with open_files(spark, len(splits)):
        _save(out.observe(seen, *counters).write.partitionBy("split"), path, fmt, compression)
    got = seen.get
    manifest = {
        "format": fmt,
        "files": files_of(spark, path),
        "splits": {s: {"rows": got.get(f"{s}.rows", 0), "sum": got.get(f"{s}.sum", 0)} for s in splits},
        "schema": json.loads(out.select(*columns).schema.json()),
    }
    text = spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1)
    text.write.text(f"{path}/_manifest")
    return path


def manifest_of(spark: SparkSession, path: str) -> dict:
    """The manifest of a published folder, if the folder has exactly the files that it names."""
    fs, done = _folder(spark, f"{path}/_manifest/_SUCCESS")
    if not fs.exists(done):
        raise Incomplete(f"{path} has no manifest")
    manifest = json.loads("".join(r.value for r in spark.read.text(f"{path}/_manifest").collect()))
    here, named = files_of(spark, path), manifest["files"]
    if here != named:
        odd = sorted(set(here) ^ set(named)) or sorted(f for f in here if here[f] != named[f])
        raise Incomplete(f"{path} has other files than its manifest names: {', '.join(odd[:3])}")
    return manifest


def read_published(spark: SparkSession, path: str, split: str, verify: bool = False) -> DataFrame:
    """SRC-4: one split of a whole data set. ``verify``: its rows must have the manifest's count and sum."""
    from pyspark.sql import types as T

    manifest = manifest_of(spark, path)
    if split not in manifest["splits"]:
        raise Incomplete(f"{path} has no split {split}")
    schema = T.StructType.fromJson(manifest["schema"])
    if not any(f.startswith(f"split={split}/") for f in manifest["files"]):
        rows = spark.createDataFrame([], schema)
    else:
        rows = spark.read.schema(schema).format(manifest["format"]).load(f"{path}/split={split}")
    if verify:
        got = rows.agg(F.count("*").alias("rows"), row_sum(rows.columns).alias("sum")).first().asDict()
        if got != manifest["splits"][split]:
            raise Incomplete(f"{path}: split {split} holds {got}, the manifest says {manifest['splits'][split]}")
    return rows


def latest(spark: SparkSession, base: str) -> str | None:
    """The newest whole data set of ``base``; folders without a manifest are passed over."""
    fs, root = _folder(spark, base)
    if not fs.exists(root):
        return None
    names = sorted((s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()), reverse=True)
    return next((f"{base.rstrip('/')}/{n}" for n in names if fs.exists(_folder(spark, f"{base}/{n}/_manifest/_SUCCESS")[1])), None)
