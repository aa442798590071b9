"""UDF-1 as a table function: ``map_and_quarantine``'s function callable from SQL with ``LATERAL``.

    register_table_function(spark, "quantities", fn, schema, "string")
    SELECT r.*, q.* FROM raw r, LATERAL quantities(r.text) q

One call takes one value and gives the function's results or one failed row, with the
same error columns as ``mapping.map_and_quarantine``; Spark runs the calls in the executors' Python workers.

With ``LATERAL`` Spark takes an Arrow batch for each call, which costs several times the
call where it gives a few rows. So results of ``PLAIN`` types come as rows, many calls at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import UserDefinedTableFunction

from daybook.operators.mapping import ADDED, Outputs


#: Types whose values come through a row as they are in the column.
PLAIN = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DoubleType, T.StringType, T.BooleanType, T.DateType)


def table_function(fn: Callable[[Any], Any], schema: T.StructType) -> UserDefinedTableFunction:
    """A table function of one argument with the columns of ``schema`` and the error columns."""
    outputs, plain = Outputs(fn, schema), all(isinstance(f.dataType, PLAIN) for f in schema.fields)

    class Mapped:
        def eval(self, value: Any) -> Iterator[tuple]:
            for row in outputs(value, plain=plain):
                yield tuple(row)

    return F.udtf(Mapped, returnType=T.StructType([*schema.fields, *ADDED]), useArrow=not plain)


def register_table_function(spark: SparkSession, name: str, fn: Callable[[Any], Any], schema: T.StructType) -> UserDefinedTableFunction:
    made = table_function(fn, schema)
    spark.udtf.register(name, made)
    return made
