"""Model input layout and batching (PRJ-6/7, SEQ-12..14, SRT-2/3).

* ``model_layout``: the 9 model columns, scalars tiled along the 31 steps and
  every feature given a trailing axis of 1 -> ``array<array<...>>`` (time, 1).
* ``feature_target_split``: two struct columns ``features`` / ``label``.
* ``step_matrix``: one (31, F) matrix per example, ``array<array<double>>``.
* ``shuffle_key`` / ``assign_batches``: a repeatable shuffle and global,
  consecutive batch numbers with the incomplete last batch dropped.

Batch numbering never funnels rows through one task: the shuffle key is a
hash, so its leading digits split the rows into even ranges; the ranges'
counts form a table of fixed size, whose running sum gives each range's
offset; a row's place in its range is where the sorted write put it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook import spec
from daybook.functions.steps import settled
from daybook.session import work_path

KEYS = ["item_id", "year", "month"]
STEP_FEATURES = spec.STEP_FEATURES


def model_layout(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """PRJ-7 + SEQ-12/13: keep the model columns, shaped (time, 1), and those of ``keep`` as they are."""
    cols = [F.col(c) for c in keep or []] + [F.col(c) for c in KEYS if c not in spec.MODEL_TILED_FEATURES] + [F.col("valid_day")]
    for c in spec.MODEL_TILED_FEATURES:
        cols.append(F.array_repeat(F.array(F.col(c)), spec.SEQ_LEN).alias(c))
    for c in spec.MODEL_SEQUENCE_FEATURES:
        cols.append(F.transform(c, lambda x: F.array(x)).alias(c))
    return df.select(*cols)


def feature_target_split(df: DataFrame, target: str = spec.TARGET) -> DataFrame:
    """PRJ-6: ``features`` (every other column) and ``label`` (the target)."""
    feats = [c for c in df.columns if c != target]
    return df.select(F.struct(*feats).alias("features"), F.col(target).alias("label"))


def step_matrix(
    df: DataFrame, features: list[str] | None = None, name: str = "steps", keep: list[str] | None = None
) -> DataFrame:
    """SEQ-14: per example a (31, F) matrix, scalars repeated on every step."""
    features = features or STEP_FEATURES
    seq = set(spec.SEQUENCE_FEATURES)
    row = lambda i: F.array(
        *[(F.get(F.col(c), i) if c in seq else F.col(c)).cast("double") for c in features]
    )
    steps = F.transform(F.sequence(F.lit(0), F.lit(spec.SEQ_LEN - 1)), row)
    read = [c for c in df.columns if c in (*KEYS, *features, *(keep or []))]
    return settled(df.select(*read)).select(*KEYS, *(keep or []), steps.alias(name))


def shuffle_key(seed: int = 42, keys: list[str] | None = None) -> Column:
    """SRT-2: the order key of a row, 15 hexadecimal digits of a hash of seed and keys.

    Any seed gives an order of its own; SQL engines with ``md5`` agree on it.
    """
    keys = keys or KEYS
    return F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])), 1, 15)


def seeded_shuffle(df: DataFrame, seed: int = 42, keys: list[str] | None = None) -> DataFrame:
    """SRT-2: the whole table in shuffled order (range-partitioned global sort)."""
    keys = keys or KEYS
    return df.withColumn("shuffle_key", shuffle_key(seed, keys)).orderBy("shuffle_key", *keys)


def positions(df: DataFrame, seed: int = 42, keys: list[str] | None = None, digits: int = 3) -> DataFrame:
    """Append ``shuffle_key``, ``position`` in shuffled order and ``n_total``.

    The leading ``digits`` of the key make 16 ** digits even ranges. The rows are dealt
    by range, sorted and written once to the shared work folder, each with its seat there; a scan of ranges
    and seats alone then counts each range, and a row's position is its range's offset and
    its seat within the range. Nothing is shuffled or sorted again. The number of ranges
    is the parallelism of the sort and the bound of the broadcast counts (4,096
    by default; 4 digits for 65,536), whatever the table's size.
    """
    keys = keys or KEYS
    spark = df.sparkSession
    path = work_path(spark, "shuffled")
    dealt = df.withColumn("shuffle_key", shuffle_key(seed, keys)).withColumn("_range", F.substring("shuffle_key", 1, digits))
    ordered = dealt.repartition("_range").sortWithinPartitions("_range", "shuffle_key", *keys)
    ordered.withColumn("_seat", F.monotonically_increasing_id()).write.parquet(path)
    seated = spark.read.parquet(path)
    counts = seated.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_seat").alias("_first"))
    running = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select(
        "_range",
        (F.sum("_n").over(running) - F.col("_n") - F.col("_first")).alias("_offset"),
        F.sum("_n").over(Window.partitionBy()).alias("n_total"),
    )
    placed = seated.join(F.broadcast(offsets), "_range")
    return placed.withColumn("position", F.col("_offset") + F.col("_seat")).drop("_range", "_offset", "_seat")


def assign_batches(df: DataFrame, batch_size: int, seed: int = 42, keys: list[str] | None = None, digits: int = 3) -> DataFrame:
    """SRT-3: ``position`` in shuffled order and ``batch_id = position div batch_size``;
    rows of the last, incomplete batch are left out (drop_remainder)."""
    placed = positions(df, seed, keys, digits)
    batch = F.floor(F.col("position") / batch_size).cast("bigint")
    full = F.floor(F.col("n_total") / batch_size)
    return placed.withColumn("batch_id", batch).where(F.col("batch_id") < full).drop("n_total")


def training_batches(examples: DataFrame, batch_size: int, seed: int = 42, digits: int = 3) -> DataFrame:
    """Exported examples -> model layout, target apart, shuffled and cut into batches, with all features."""
    place = ["batch_id", "position", "sample"]
    batched = assign_batches(examples, batch_size, seed, digits=digits).withColumn("sample", F.struct(*KEYS))
    shaped = model_layout(batched, keep=place)
    features = [c for c in shaped.columns if c not in (*place, spec.TARGET)]
    return shaped.select("batch_id", "position", "sample.*", F.struct(*features).alias("features"), F.col(spec.TARGET).alias("label"))
