"""SRC-4 in interleaved order: a row from each file of a cycle in turn (Parquet).

Files are taken ``cycle`` at a time, in order of their paths; of these the first
rows come first, then the second rows, and so on, files that have ended being
passed over. A row's place follows from its own file and index and from the files' lengths:

    rows of earlier cycles + rows of lesser index in the cycle + files before its own that have its index

so no sort and no window over rows is needed. The lengths are a table of one row a file,
broadcast. A folder ``shard=...`` counts as one file, its files in order of their names. ``_metadata`` gives file and index; both stay with the
row whatever way Spark splits the files.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CYCLE = 4


def write_shards(df: DataFrame, path: str, shards: int, keys: list[str], shard) -> None:
    """``shards`` folders of rows in key order, row r in folder ``shard`` (a column expression of 0 to ``shards`` - 1).

    A shard's rows are dealt by ranges of the keys, so that a task sorts and writes a part of
    a shard, whatever the number of shards; a shard's files, in order of their names, follow each other."""
    dealt = df.withColumn("shard", shard.cast("int"))
    parts = max(shards, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = dealt.repartitionByRange(parts, "shard", *keys).sortWithinPartitions("shard", *keys)
    dealt.write.mode("overwrite").partitionBy("shard").parquet(path)


def read_interleaved(spark: SparkSession, path: str, schema, cycle: int = CYCLE) -> DataFrame:
    """The rows with ``position``, their place in interleaved order, from 0."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
    rows = rows.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row"))
    # one row a file from here on: a listing, not data
    lengths = rows.groupBy("_path").agg((F.max("_row") + 1).alias("_rows"))
    lengths = lengths.withColumn("_file", F.regexp_replace("_path", r"(/shard=[^/]+)/[^/]+$", "$1"))
    in_shard = Window.partitionBy("_file").orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)
    parts = lengths.select("_path", "_file", F.coalesce(F.sum("_rows").over(in_shard), F.lit(0)).alias("_start"))
    seat = F.row_number().over(Window.orderBy("_file")) - 1
    files = lengths.groupBy("_file").agg(F.sum("_rows").alias("_n")).withColumn("_seat", seat)
    files = files.withColumn("_cycle", F.floor(F.col("_seat") / cycle))
    rounds = files.groupBy("_cycle").agg(F.array_sort(F.collect_list(F.struct("_seat", "_n"))).alias("_group"), F.sum("_n").alias("_all"))
    before = F.coalesce(F.sum("_all").over(Window.orderBy("_cycle").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = files.join(rounds.withColumn("_before", before), "_cycle").join(parts, "_file").select("_path", "_start", "_seat", "_group", "_before")
    joined = rows.join(F.broadcast(placed), "_path").withColumn("_index", F.col("_start") + F.col("_row"))
    lesser = F.aggregate("_group", F.lit(0).cast("long"), lambda n, g: n + F.least(g["_n"], F.col("_index")))
    earlier = F.aggregate("_group", F.lit(0).cast("long"), lambda n, g: n + F.when((g["_seat"] < F.col("_seat")) & (g["_n"] > F.col("_index")), 1).otherwise(0))
    joined = joined.withColumn("position", F.col("_before") + lesser + earlier)
    return joined.drop("_path", "_row", "_start", "_index", "_seat", "_group", "_before")


def shard_path(path: str, shard: int) -> str:
    return os.path.join(path, f"shard={shard}")
