"""UDF-1: apply an arbitrary Python function, keep its failures (MapAndFilterErrors).

The function sees one input value (or a dict of the selected columns) and
returns a mapping (one output row) or a list of them (several rows). An
exception does not fail the task: the input lands in the output with its
class (AssertionErrors, KeyErrors, TypeErrors, ValueErrors, other_errors),
message and raw text, so ``quality.good`` / ``quality.quarantine`` split it.

This is the slow path (Python per element inside Arrow batches); built-in
expressions are used wherever they can say the same thing.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def error_class_of(exc: BaseException) -> str:
    """Counter name for an exception, first matching class wins."""
    if isinstance(exc, AssertionError):
        return "AssertionErrors"
    if isinstance(exc, KeyError):
        return "KeyErrors"
    if isinstance(exc, TypeError):
        return "TypeErrors"
    if isinstance(exc, ValueError):
        return "ValueErrors"
    return "other_errors"


#: Columns that ``map_and_quarantine`` adds to the declared ones.
ADDED = [
    T.StructField("error_class", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("raw", T.StringType()),
    T.StructField("output", T.IntegerType()),
]


def results(mapped: DataFrame) -> DataFrame:
    """The function's results, without failures and without marks of empty lists."""
    added = {f.name for f in ADDED}
    return mapped.where("error_class IS NULL AND output >= 0").select(*[c for c in mapped.columns if c not in added])


def input_count() -> Column:
    """How many inputs the rows come from: each has one row with output 0 or -1."""
    return F.count_if(F.col("output") <= 0)


class Outputs:
    """Output rows of one input: the function's results, or one failed row, in the order of ``schema`` and ``ADDED``."""

    def __init__(self, fn: Callable[[Any], Any], schema: T.StructType):
        self.fn, self.schema = fn, schema
        self.names = [f.name for f in schema.fields]
        self.empty = [None] * len(self.names)
        self.arrow = to_arrow_schema(T.StructType([*schema.fields, *ADDED]))

    def project(self, item: Any) -> list:
        if isinstance(item, dict):
            return [item.get(n) for n in self.names]
        return [item] if len(self.names) == 1 else list(self.empty)

    def check(self, row: list) -> list:
        for value, field in zip(row, self.arrow):
            try:
                pa.array([value], field.type)
            except (pa.ArrowException, TypeError, ValueError, OverflowError) as exc:
                raise TypeError(f"{field.name}: {exc}") from exc
        return row

    def checked(self, rows: list[list], plain: bool) -> list[list]:
        """``rows`` if all values fit: whole columns at once, and value by value only to name one that does not.

        ``plain``: the values come back as their columns hold them, 5 for a long given as 5.0, and texts as ``str``."""
        given = list(zip(*rows))
        try:
            columns = [pa.array(values, field.type) for values, field in zip(given, self.arrow)]
        except (pa.ArrowException, TypeError, ValueError, OverflowError):
            return [self.check(row) for row in rows]
        if not plain or not columns:
            return rows
        text = lambda values: [None if v is None else str(v) for v in values]
        return list(zip(*[text(v) if pa.types.is_string(c.type) else c.to_pylist() for v, c in zip(given, columns)]))

    def __call__(self, record: Any, check: bool = True, plain: bool = False) -> list[list]:
        try:
            found = self.fn(record)
            rows = [self.project(item) for item in (found if isinstance(found, list) else [found])]
            rows = self.checked(rows, plain) if check else rows
        except Exception as exc:  # noqa: BLE001 - every failure is classified
            raw = record if isinstance(record, str) else json.dumps(record, default=str)
            return [[*self.empty, error_class_of(exc), str(exc), raw, 0]]
        return [[*row, None, None, None, i] for i, row in enumerate(rows)] or [[*self.empty, None, None, None, -1]]

    def batch(self, records: list) -> pa.RecordBatch:
        """All rows of many inputs: whole columns at once, and value by value only if some value does not fit its type."""
        try:
            return self._columns([row for r in records for row in self(r, check=False)])
        except (pa.ArrowException, TypeError, ValueError, OverflowError):
            return self._columns([row for r in records for row in self(r)])

    def _columns(self, rows: list[list]) -> pa.RecordBatch:
        columns = [pa.array([row[k] for row in rows], field.type) for k, field in enumerate(self.arrow)]
        return pa.RecordBatch.from_arrays(columns, schema=self.arrow)


def map_and_quarantine(
    df: DataFrame,
    fn: Callable[[Any], Any],
    schema: T.StructType,
    input_cols: list[str] | None = None,
) -> DataFrame:
    """Run ``fn`` on every row of ``df[input_cols]``; output ``schema`` plus
    ``error_class``, ``error_message``, ``raw`` (NULL on good rows) and ``output``:
    the place of the result among its input's results, 0 for a failure, -1 for
    an input whose list of results is empty.

    Results are built as Arrow columns of the declared types, so a failure
    beside them changes no value; a result that does not fit its type is a
    failure of its input (TypeErrors). ``fn`` is run again on the inputs of a
    batch that holds such a result.
    """
    cols = input_cols or df.columns
    outputs = Outputs(fn, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield outputs.batch(batch.column(0).to_pylist() if len(cols) == 1 else batch.to_pylist())

    return df.select(*cols).mapInArrow(run, T.StructType([*schema.fields, *ADDED]))
