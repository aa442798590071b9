"""Rollup: sale lines -> (item, day) -> one ordered sequence per (item, month).

AGG-1..6, PRJ-1, SRT-1. ``ANY_VALUE`` of the source is made repeatable:
``min`` for the description, and the four measures are all taken from the
first day of the month (one consistent row, ``min_by`` on the date).

Scale notes
-----------
* Lines are dealt once by (item, month), in the few columns that are used, and
  every level is worked out from that one exchange.
* They are first summed by (item, date, description) with numeric buffers: a
  hash aggregate that takes the lines as they come, so no raw line is sorted (a
  string ``min`` there would make it a sort-based aggregate) and a group that is
  sorted or collected later has at most 31 days times the descriptions of one
  item, whatever the item's volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Measures of a raw sample and the sales columns that they are means of.
SOURCES = {
    "cost": "state_bottle_cost",
    "retail": "state_bottle_retail",
    "volume_ml": "bottle_volume_ml",
    "pack_size": "pack",
}
MEASURES = list(SOURCES)
RAW_SAMPLE_COLUMNS = [
    "item_number",
    "item_description",
    "cost",
    "retail",
    "volume_ml",
    "pack_size",
    "year_month",
    "dates_arr",
    "daily_bottles_sold_arr",
]


def year_month(date_col: str = "date") -> Column:
    """``FORMAT_DATE('%Y-%m', date)``."""
    return F.date_format(date_col, "yyyy-MM")


def daily_parts(sales: DataFrame) -> DataFrame:
    """AGG-1, first level: sums and counts by (item, date, description); those of several loads can be added up."""
    sums = [F.sum(F.col(src).cast("double")).alias(f"s_{m}") for m, src in SOURCES.items()]
    counts = [F.count(src).alias(f"n_{m}") for m, src in SOURCES.items()]
    dated = sales.withColumn("year_month", year_month()).repartition("item_number", "year_month")
    parts = dated.groupBy("item_number", "year_month", "date", "item_description").agg(*sums, *counts, F.sum("bottles_sold").alias("qty"))
    return parts.select(*[c for c in parts.columns if c != "year_month"], "year_month")


def daily_of_parts(parts: DataFrame) -> DataFrame:
    """AGG-1, second level: one row per (item_number, date) with means and the day's total."""
    return parts.groupBy("item_number", "year_month", "date").agg(
        F.min("item_description").alias("item_description"),
        *[F.try_divide(F.sum(f"s_{m}"), F.sum(f"n_{m}")).alias(m) for m in MEASURES],
        F.sum("qty").alias("daily_bottles_sold"),
    )


def daily_item_sales(sales: DataFrame) -> DataFrame:
    """AGG-1: one row per (item_number, date) with means and the day's total."""
    return daily_of_parts(daily_parts(sales))


def monthly_sequences(daily: DataFrame) -> DataFrame:
    """AGG-2: one raw sample per (item_number, year_month), arrays ordered by date."""
    first_day = F.min_by(F.struct(*MEASURES), F.col("date"))
    days = F.sort_array(F.collect_list(F.struct("date", "daily_bottles_sold")))
    grouped = daily.groupBy("item_number", "year_month").agg(
        F.min("item_description").alias("item_description"),
        first_day.alias("_first"),
        days.alias("_days"),
    )
    return grouped.select(
        "item_number",
        "item_description",
        *[F.col(f"_first.{m}").alias(m) for m in MEASURES],
        "year_month",
        F.col("_days.date").alias("dates_arr"),
        F.col("_days.daily_bottles_sold").alias("daily_bottles_sold_arr"),
    )


def raw_samples(sales: DataFrame) -> DataFrame:
    """Sales lines -> raw samples (the source pipeline's query result)."""
    return monthly_sequences(daily_item_sales(sales))
