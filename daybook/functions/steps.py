"""Steps of a plan that are worked out once, whatever reads them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settled(df: DataFrame) -> DataFrame:
    """The same rows and columns, their values worked out here and once a row.

    A filter on a column is moved below the step that makes it, with the whole expression in
    place of the name; where that name stands many times, in lists above all, the work is
    repeated as often. The rows pass through a generator of one row each, below
    which no such filter goes. Only the columns that are selected before are made."""
    return df.select(F.inline(F.array(F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]))))


def inline_once(df: DataFrame, keys: list[str], rows: Column) -> DataFrame:
    """``keys`` and the fields of each element of the list ``rows``, which is worked out once."""
    return settled(df.select(*keys, rows.alias("_rows"))).select(*keys, F.inline("_rows"))
