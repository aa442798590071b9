"""Quarantine, error counters and the example validator (FLT-2, AGG-8, VAL-1..4).

Rows are never dropped silently: each stage marks failing rows with
``error_class`` / ``error_message``; ``good`` keeps the rest and the
quarantine table keeps the failures with their raw input as JSON text.
Counters are a one-pass aggregate (``error_counts``) or, piggy-backed on an
action that runs anyway, an ``Observation`` (``observe_errors``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook import spec

QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("stage", T.StringType(), False),
        T.StructField("error_class", T.StringType(), False),
        T.StructField("message", T.StringType(), True),
        T.StructField("raw", T.StringType(), True),
    ]
)


def quarantine(marked: DataFrame, stage: str, raw: Column | str | None = None) -> DataFrame:
    """Failed rows of ``marked`` in the quarantine layout.

    ``raw`` is the input to keep (a text column, or by default the other
    columns as JSON). It is computed after the filter, for failed rows only.
    """
    failed = marked.where(F.col("error_class").isNotNull())
    if raw is None:
        others = [c for c in marked.columns if c not in ("error_class", "error_message")]
        raw_col = F.to_json(F.struct(*others))
    else:
        raw_col = F.col(raw) if isinstance(raw, str) else raw
    return failed.select(
        F.lit(stage).alias("stage"),
        F.col("error_class"),
        F.col("error_message").alias("message"),
        raw_col.cast("string").alias("raw"),
    )


def good(marked: DataFrame, columns: list[str] | None = None) -> DataFrame:
    ok = marked.where(F.col("error_class").isNull())
    return ok.select(*(columns or [c for c in marked.columns if c not in ("error_class", "error_message")]))


def _count_exprs(n_elements: Column | None = None) -> list[Column]:
    cls = F.col("error_class")
    return [
        (n_elements if n_elements is not None else F.count(F.lit(1))).alias("n_elements"),
        F.count_if(cls.isNotNull()).alias("failed_elements"),
        *[F.count_if(cls == name).alias(name) for name in spec.ERROR_CLASSES],
    ]


def error_counts(marked: DataFrame, stage: str, n_elements: Column | None = None) -> DataFrame:
    """AGG-8: one row of counters for one stage (single pass, partial aggregates).

    ``n_elements``: the aggregate that counts inputs, where rows are outputs
    (``mapping.input_count()``); by default every row is an element.
    """
    return marked.agg(*_count_exprs(n_elements)).select(F.lit(stage).alias("stage"), "*")


def observe_errors(marked: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """AGG-8 without an extra job: counters filled in by the next action on the result."""
    obs = Observation(f"errors:{stage}")
    return marked.observe(obs, *_count_exprs()), obs


def staged_counts(column: str = "stage") -> Callable[[str, list[str]], list[Column]]:
    """Counters of several stages over one table whose ``column`` names the stage that failed a row.

    A row reaches a stage unless an earlier one failed it, so the counts of
    all stages come from one pass.
    """

    def counters(stage: str, earlier: list[str]) -> list[Column]:
        here = F.col(column) == stage
        reached = F.coalesce(~F.col(column).isin(earlier), F.lit(True)) if earlier else F.lit(True)
        if stage == "parse":  # its inputs are lines, of which a list has a row for each element
            reached = F.coalesce(F.col("place") == 0, F.lit(True))
        return [
            F.count_if(reached).alias(f"{stage}.n_elements"),
            F.count_if(here).alias(f"{stage}.failed_elements"),
            *[F.count_if(here & (F.col("error_class") == name)).alias(f"{stage}.{name}") for name in spec.ERROR_CLASSES],
        ]

    return counters


# -- validator (VAL-1..4) ---------------------------------------------------


def check_schema(df: DataFrame) -> None:
    """VAL-3/4 are static in Spark: column types are checked once on the schema."""
    types = {f.name: f.dataType for f in df.schema.fields}
    for f in spec.FEATURES:
        if f.name not in types:
            raise AssertionError(f"column {f.name} is missing")
        t = types[f.name]
        if f.length is not None:
            if not isinstance(t, T.ArrayType):
                raise AssertionError(f"{f.name} is {t.simpleString()} but should be an array")
            t = t.elementType
        if f.kind == "string" and not isinstance(t, T.StringType):
            raise AssertionError(f"{f.name} is {t.simpleString()} but should be string")
        if f.kind != "string" and not isinstance(t, T.NumericType):
            raise AssertionError(f"{f.name} is {t.simpleString()} but should be numeric")


def validate_examples(df: DataFrame) -> DataFrame:
    """VAL-1/2 per row: every spec column present, every sequence of length 31.

    Adds ``error_class`` = 'AssertionErrors' and a message naming the sample
    and the first broken rule (spec order), NULL for valid rows.
    """
    check_schema(df)
    # The texts of the messages
    sample_id = F.concat_ws("_", F.col("item_id"), F.col("year"), F.col("month"))
    cls, msg = None, None
    for f in spec.FEATURES:
        rules = [(F.col(f.name).isNull(), F.concat(sample_id, F.lit(f" is missing {f.name}")))]
        if f.length is not None:
            rules.append(
                (
                    F.size(f.name) != f.length,
                    F.concat(sample_id, F.lit(f": {f.name} shape ("), F.size(f.name).cast("string"), F.lit(f",) but should be ({f.length},)")),
                )
            )
            rules.append((F.exists(f.name, lambda x: x.isNull()), F.concat(sample_id, F.lit(f": {f.name} has a missing element"))))
        for cond, text in rules:
            cls = F.when(cond, F.lit("AssertionErrors")) if cls is None else cls.when(cond, F.lit("AssertionErrors"))
            msg = F.when(cond, text) if msg is None else msg.when(cond, text)
    return df.withColumns({"error_class": cls, "error_message": msg})
