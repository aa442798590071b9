"""Sales source (SRC-1) and the date-window filter (FLT-1).

A sales table is any DataFrame with (or mapped onto) the columns of
``SALES_SCHEMA``. Adapters for the driver's tables live here too.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALES_SCHEMA = T.StructType(
    [
        T.StructField("item_number", T.StringType()),
        T.StructField("item_description", T.StringType()),
        T.StructField("state_bottle_cost", T.DoubleType()),
        T.StructField("state_bottle_retail", T.DoubleType()),
        T.StructField("bottle_volume_ml", T.LongType()),
        T.StructField("pack", T.LongType()),
        T.StructField("date", T.DateType()),
        T.StructField("bottles_sold", T.LongType()),
    ]
)
SALES_COLUMNS = [f.name for f in SALES_SCHEMA.fields]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def sales_scan(source: DataFrame, mapping: dict[str, Column | str] | None = None) -> DataFrame:
    """Project ``source`` onto the sales columns.

    ``mapping`` names, for each sales column, the source column or expression
    that fills it; unmapped columns are taken by name. Only the mapped
    columns reach the file scan (Catalyst prunes the rest). A value that does
    not fit becomes NULL here; ``mark_sales`` keeps it for quarantine.
    """
    return source.select(*[c.try_cast(f.dataType).alias(f.name) for f, c in _mapped(mapping)])


def _mapped(mapping: dict[str, Column | str] | None) -> list[tuple[T.StructField, Column]]:
    exprs = [(f, (mapping or {}).get(f.name, f.name)) for f in SALES_SCHEMA.fields]
    return [(f, F.col(e) if isinstance(e, str) else e) for f, e in exprs]


def mark_sales(source: DataFrame, mapping: dict[str, Column | str] | None = None) -> DataFrame:
    """The sales columns, with error columns and the raw row for values that do not fit their column's type.

    ``quality.good`` gives the lines to use, ``quality.quarantine(…, "scan", "raw")`` the others.
    """
    bad = lambda f, c: c.isNotNull() & c.try_cast(f.dataType).isNull()
    cls, msg = F.lit(None).cast("string"), F.lit(None).cast("string")
    for f, c in reversed(_mapped(mapping)):
        cls = F.when(bad(f, c), F.lit("ValueErrors")).otherwise(cls)
        msg = F.when(bad(f, c), F.lit(f"{f.name} is not a {f.dataType.simpleString()}")).otherwise(msg)
    typed = [c.try_cast(f.dataType).alias(f.name) for f, c in _mapped(mapping)]
    raw = F.when(cls.isNotNull(), F.to_json(F.struct("*")))
    return source.select(*typed, cls.alias("error_class"), msg.alias("error_message"), raw.alias("raw"))


def lineitem_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's ``lineitem`` seen as a sales table (supplier = item).

    Integer-valued measures keep means bit-identical across engines.
    """
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return sales_scan(
        table(spark, sf_dir, "lineitem"),
        {
            "item_number": F.col("l_suppkey").cast("string"),
            "item_description": F.concat(F.col("l_returnflag"), F.lit("-"), F.col("l_linestatus")),
            "state_bottle_cost": cents - F.col("l_linenumber") * 100,
            "state_bottle_retail": cents,
            "bottle_volume_ml": F.col("l_linenumber") * 250,
            "pack": F.col("l_linenumber"),
            "date": F.col("l_shipdate").cast("date"),
            "bottles_sold": F.col("l_quantity").cast("bigint"),
        },
    )


def events_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's ``events`` seen as a sales table: thin sequences (user = item)."""
    return sales_scan(
        table(spark, sf_dir, "events"),
        {
            "item_number": F.col("user_id").cast("string"),
            "item_description": F.col("event_type"),
            "state_bottle_cost": F.round(F.col("value") * 100),
            "state_bottle_retail": F.round(F.col("value") * 100),
            "bottle_volume_ml": F.lit(750).cast("bigint"),
            "pack": F.lit(12).cast("bigint"),
            "date": F.to_date("ts"),
            "bottles_sold": F.lit(1).cast("bigint"),
        },
    )


def date_window(sales: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """``date BETWEEN start AND end``, both ends included.

    Expressed on the ``date`` column so Catalyst pushes it through the cast
    into the parquet scan (PushedFilters on the raw timestamp column).
    """
    return sales.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
