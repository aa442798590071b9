"""Structured Streaming form of the row-local chain.

Preparation, validation, the split, scaling with saved constants and scoring
are all row-local (no aggregation), so the batch code runs unchanged on each
micro-batch of a file stream of JSON lines:

    readStream.text -> foreachBatch:
        parse -> prepare -> validate -> split (stage and class of each error)
        -> write once, counted -> scale (saved min/max) -> [score, counted] -> write

Each micro-batch writes to folders named after its epoch with mode
``overwrite``: a batch replayed after a failure rewrites the same folders,
so the output is exactly-once together with the stream checkpoint. The
counters of all stages are observed by the batch's own write and are one of these
folders (``_counters``): they are there when, and only when, the epoch's rows are, and
``stream_counts`` adds them up over epochs and restarts. (Progress events of a
query listener would be lost with the driver and are not sent again.)
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daybook import spec
from daybook.operators import training
from daybook.operators.scaling import MinMax, apply_minmax
from daybook.operators.scoring import score_mllib, step_inputs, to_predictions
from daybook.operators.split import mark_split
from daybook.plans.train import STAGES, examples_of_lines, stage_examples
from daybook.session import drop_path
from daybook.sources import examples

COUNTERS = ", ".join(["stage string", *[f"{c} long" for c in ("n_elements", "failed_elements", *spec.ERROR_CLASSES)]])


def process_batch(
    spark: SparkSession,
    lines: DataFrame,
    epoch: int,
    out_dir: str,
    fitted: MinMax,
    scorer: training.Scorer | None = None,
    pred_date: str | None = None,
    split_date: str = "2020-01-01",
) -> None:
    """One micro-batch of lines -> examples with their split, quarantine, predictions, counters."""

    def write(df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").parquet(os.path.join(out_dir, name, f"epoch={epoch}"))

    failed = ["stage", "error_class", F.col("error_message").alias("message"), "raw"]
    path, counts = stage_examples(spark, examples_of_lines(lines), STAGES)
    staged = [path]
    try:
        table = spark.read.parquet(path)
        good = mark_split(table.where("stage IS NULL").select(*spec.FEATURE_NAMES), split_date).drop("error_class", "error_message")
        write(examples.to_export(apply_minmax(good, fitted), ["split"]), "examples")
        bad = table.where("stage IS NOT NULL").select(*failed)
        if scorer:
            inputs = step_inputs(good, pred_date, scorer.ready(good.schema))
            scored = score_mllib(scorer.model, inputs).withColumn("stage", F.when(F.col("error_class").isNotNull(), F.lit("score")))
            path, more = stage_examples(spark, scored.withColumnRenamed("score_raw", "raw"), ["score"])
            staged.append(path)
            counts += more
            write(to_predictions(spark.read.parquet(path)), "predictions")
            bad = bad.unionByName(spark.read.parquet(path).where("stage IS NOT NULL").select(*failed))
        write(bad, "_quarantine")
        names = [c.split()[0] for c in COUNTERS.split(", ")]
        write(spark.createDataFrame([tuple(c[n] for n in names) for c in counts], COUNTERS).coalesce(1), "_counters")
    finally:
        for path in staged:
            drop_path(spark, path)


def stream_counts(spark: SparkSession, out_dir: str) -> DataFrame:
    """AGG-8 of a stream: the counters of each stage over all epochs."""
    rows = spark.read.schema(COUNTERS + ", epoch long").parquet(os.path.join(out_dir, "_counters"))
    return rows.groupBy("stage").agg(*[F.sum(c).alias(c) for c in rows.columns if c not in ("stage", "epoch")])


def start_prepare_stream(
    spark: SparkSession,
    json_dir: str,
    out_dir: str,
    dataset_dir: str,
    model_dir: str | None = None,
    pred_date: str | None = None,
    checkpoint: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    split_date: str = "2020-01-01",
) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops.

    Scaler and model are loaded once, here. The checkpoint lies beside the
    output by default: a second start goes on where the first ended, so no file
    is processed twice.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    fitted = examples.load_minmax(spark, dataset_dir)
    scorer = training.load_scorer(model_dir) if model_dir else None
    writer = reader.load(json_dir).writeStream.foreachBatch(
        lambda df, epoch: process_batch(spark, df, epoch, out_dir, fitted, scorer, pred_date, split_date)
    ).option("checkpointLocation", checkpoint or os.path.join(out_dir, "_checkpoint"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
