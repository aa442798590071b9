"""Newline-delimited JSON source (SRC-2/3, FN-12).

``read_lines`` is ``spark.read.text``; ``parse_lines`` turns each line into one
or more JSON elements as VARIANT: an object gives one element, a top-level
list gives one per item (``[]`` gives none), a line that is not JSON is marked
``ValueErrors`` at stage ``parse``. Scalars and ``null`` pass this stage and
fail later, in preparation, as the source pipeline does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """SRC-2: one row per line, column ``value``; files are read in parallel splits."""
    return spark.read.text(path)


#: A bare not-a-number or infinity where JSON wants a value.
NOT_FINITE = r"([:\[,]\s*)(NaN|-?Infinity)(?=\s*[,\]}])"


def mark_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Stage ``parse``: VARIANT per line plus error columns (one row per line).

    Of a key given twice the last value counts. A line that is not strict JSON
    is read once more with bare ``NaN`` and ``Infinity`` as text, which the
    number fields read as such; where quoting them would cut a text in two the
    line stays unread and goes to quarantine.
    """
    lines.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    quoted = F.regexp_replace(F.col(column), NOT_FINITE, '$1"$2"')
    v = F.coalesce(F.try_parse_json(F.col(column)), F.try_parse_json(quoted))
    bad = v.isNull()
    return lines.select(
        F.col(column).alias("line"),
        v.alias("doc"),
        F.when(bad, F.lit("ValueErrors")).alias("error_class"),
        F.when(bad, F.lit("line is not valid JSON")).alias("error_message"),
    )


def explode_elements(marked: DataFrame, outer: bool = False) -> DataFrame:
    """Good lines -> one row per element (column ``v``, its ``place`` in the line), list lines flattened.

    A line that is an empty list has no element and no row, as in the source. ``outer``: a
    failed line is kept, as one row without element or place, beside its error columns.
    """
    doc = F.col("doc")
    is_list = F.coalesce(F.schema_of_variant(doc).startswith("ARRAY"), F.lit(False))
    items = F.when(is_list, F.variant_get(doc, "$", "array<variant>")).otherwise(F.array(doc))
    if not outer:
        return marked.where(F.col("error_class").isNull()).select(F.col("line"), F.posexplode(items).alias("place", "v"))
    items = F.when(F.col("error_class").isNull(), items)
    every = marked.select("line", "error_class", "error_message", F.posexplode_outer(items).alias("place", "v"))
    return every.where("place IS NOT NULL OR error_class IS NOT NULL")


def parse_lines(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(elements, parse-marked lines). The second feeds counters and quarantine."""
    marked = mark_lines(lines, column)
    return explode_elements(marked), marked
