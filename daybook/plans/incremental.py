"""AGG-1 / AGG-2 kept up to date load by load.

The newest, partial month is read again and again. Instead of rolling the
whole table up each time, the mergeable sums of AGG-1's first level are
stored, one folder a month and load, and a load touches only its months:

    <base>/parts/year_month=2020-07/load=...    sums and counts by (item, date, description)
    <base>/samples/year_month=2020-07           the raw samples of the month

A load writes its own parts, then rebuilds the samples of the months it
touches from all loads' parts. Both are dynamic partition overwrites, so a load
that is repeated after a failure replaces itself and adds nothing. One load runs at a
time.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators.rollup import daily_of_parts, daily_parts, monthly_sequences
from daybook.session import drop_path, work_path

FOLDERS = ["year_month", "load"]


def _overwrite(df: DataFrame, path: str, folders: list[str]) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)


def _schema(df: DataFrame, folders: list[str]) -> T.StructType:
    """Data columns first, folders last, as text: a month is no number or date."""
    own = [f for f in df.schema.fields if f.name not in folders]
    return T.StructType([*own, *[T.StructField(c, T.StringType()) for c in folders]])


def _in(months: list[str | None]) -> Column:
    known = F.col("year_month").isin([m for m in months if m is not None])
    return known | F.col("year_month").isNull() if None in months else known


def load_sales(sales: DataFrame, base: str, load: str) -> list[str | None]:
    """Add the lines of load ``load`` to the tables under ``base``; the months touched (as many as the load has)."""
    spark = sales.sparkSession
    parts = daily_parts(sales).withColumn("load", F.lit(load))
    kept = work_path(spark, "load")
    parts.write.parquet(kept)
    try:
        parts = spark.read.schema(parts.schema).parquet(kept)
        months = [r.year_month for r in parts.select("year_month").distinct().collect()]
        if months:
            _overwrite(parts, os.path.join(base, "parts"), FOLDERS)
            _rebuild(spark, base, parts, months)
    finally:
        drop_path(spark, kept)
    return months


def _rebuild(spark: SparkSession, base: str, like: DataFrame, months: list[str | None]) -> None:
    found = spark.read.schema(_schema(like, FOLDERS)).parquet(os.path.join(base, "parts")).where(_in(months))
    dealt = found.repartition("item_number", "year_month")
    _overwrite(monthly_sequences(daily_of_parts(dealt)), os.path.join(base, "samples"), ["year_month"])


def samples(spark: SparkSession, base: str, months: list[str | None] | None = None) -> DataFrame:
    """The raw samples of all months, or of some: a scan of their folders alone."""
    path = os.path.join(base, "samples")
    stored = spark.read.parquet(path)
    rows = spark.read.schema(_schema(stored, ["year_month"])).parquet(path)
    return rows if months is None else rows.where(_in(months))
