"""Column expressions that read one raw-sample field the way the source's
Python code does (``int(x)``, ``float(x)``, ``np.array(x, dtype=int)``,
``pd.to_datetime(x)``), without ever raising: every check is a boolean column.

Two readers share one interface:

* ``TableFields`` for typed columns (a table or the rollup output): a field is
  always present, and only NULLs and unparseable text can fail.
* ``VariantFields`` for JSON input parsed to VARIANT: tells an absent key
  (KeyError) from a JSON null (TypeError) and strings from numbers.

ANSI mode is on in Spark 4, so only ``try_*`` casts and ``get`` (NULL when out
of range) are used here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts that ``float()`` reads; Spark's cast also takes a type letter and hexadecimal digits. Digits grouped by ``_`` are not read.
NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def _try_cast(col: Column, to: str) -> Column:
    return col.try_cast(to)


def _text_to_double(text: Column) -> Column:
    return F.when(text.rlike(NUMBER), _try_cast(F.trim(text), "double"))


class TableFields:
    """Reader over typed columns named like the raw-sample keys."""

    def __init__(self, schema: T.StructType):
        self.types = {f.name: f.dataType for f in schema.fields}

    def present(self, name: str) -> Column:
        return F.lit(name in self.types)

    def is_null(self, name: str) -> Column:
        return F.col(name).isNull() if name in self.types else F.lit(True)

    def wrong_container(self, name: str) -> Column:
        """True where the value is a list/dict where a scalar is needed."""
        return F.lit(False)

    def is_string(self, name: str) -> Column:
        return F.lit(isinstance(self.types.get(name), T.StringType))

    def is_array(self, name: str) -> Column:
        return F.lit(isinstance(self.types.get(name), T.ArrayType))

    def string(self, name: str) -> Column:
        t = self.types.get(name)
        return F.col(name) if isinstance(t, T.StringType) else F.col(name).cast("string")

    def long_value(self, name: str) -> Column:
        """``int(x)``; NULL where Python raises ValueError."""
        t = self.types.get(name)
        if isinstance(t, T.StringType):
            return _try_cast(F.col(name), "bigint")
        if isinstance(t, (T.FloatType, T.DoubleType)):
            return _try_cast(F.col(name), "bigint")  # int(float) truncates
        return F.col(name).cast("bigint")

    def double_value(self, name: str) -> Column:
        """``float(x)``; NULL where Python raises ValueError."""
        t = self.types.get(name)
        if isinstance(t, T.StringType):
            return _text_to_double(F.col(name))
        return F.col(name).cast("double")

    def long_array(self, name: str) -> tuple[Column, Column, Column]:
        """``np.array(x, dtype=int)`` -> (values, any element NULL, any element unparseable)."""
        t = self.types[name]
        src = F.col(name)
        if isinstance(t.elementType, T.StringType):
            vals = F.transform(src, lambda x: _try_cast(x, "bigint"))
            bad = F.exists(F.arrays_zip(src.alias("s"), vals.alias("v")), lambda z: z["s"].isNotNull() & z["v"].isNull())
        else:
            vals = F.transform(src, lambda x: x.cast("bigint"))
            bad = F.lit(False)
        has_null = F.exists(src, lambda x: x.isNull())
        return vals, has_null, bad

    def date_array(self, name: str) -> tuple[Column, Column]:
        """Dates of the list -> (values, any element NULL or unparseable)."""
        t = self.types[name]
        src = F.col(name)
        if isinstance(t.elementType, T.StringType):
            vals = F.transform(src, lambda x: F.try_to_date(x))
        else:
            vals = F.transform(src, lambda x: x.cast("date"))
        return vals, F.exists(vals, lambda x: x.isNull())


class VariantFields:
    """Reader over one VARIANT column holding a JSON object per row.

    ``extract`` pulls every key out once (value as VARIANT and its type name)
    so the checks below read plain columns instead of re-walking the variant.
    """

    def __init__(self, column: str = "v"):
        self.column = column
        self.v = F.col(column)

    def extract(self, df, keys: list[str]):
        cols = {}
        for k in keys:
            cols[f"_vf_{k}"] = F.variant_get(self.v, f"$.{k}", "variant")
        out = df.withColumns(cols)
        kinds = {f"_vk_{k}": F.schema_of_variant(F.col(f"_vf_{k}")) for k in keys}
        kinds["_vk__"] = F.schema_of_variant(self.v)
        return out.withColumns(kinds)

    def _get(self, name: str) -> Column:
        return F.col(f"_vf_{name}")

    def _kind(self, name: str) -> Column:
        return F.col(f"_vk_{name}")

    def element_is_object(self) -> Column:
        return F.coalesce(F.col("_vk__").startswith("OBJECT"), F.lit(False))

    def present(self, name: str) -> Column:
        return self._get(name).isNotNull()

    def is_null(self, name: str) -> Column:
        return F.coalesce(F.is_variant_null(self._get(name)), F.lit(True))

    def wrong_container(self, name: str) -> Column:
        k = self._kind(name)
        return F.coalesce(k.startswith("ARRAY") | k.startswith("OBJECT"), F.lit(False))

    def is_string(self, name: str) -> Column:
        return F.coalesce(self._kind(name) == "STRING", F.lit(False))

    def is_array(self, name: str) -> Column:
        return F.coalesce(self._kind(name).startswith("ARRAY"), F.lit(False))

    def string(self, name: str) -> Column:
        return F.try_variant_get(self._get(name), "$", "string")

    def long_value(self, name: str) -> Column:
        # strings parse as integer text; JSON numbers truncate like int(float)
        return F.try_variant_get(self._get(name), "$", "bigint")

    def double_value(self, name: str) -> Column:
        text = F.try_variant_get(self._get(name), "$", "string")
        return F.when(self.is_string(name), _text_to_double(text)).otherwise(F.try_variant_get(self._get(name), "$", "double"))

    def long_array(self, name: str) -> tuple[Column, Column, Column]:
        items = F.try_variant_get(self._get(name), "$", "array<variant>")
        vals = F.transform(items, lambda x: F.try_variant_get(x, "$", "bigint"))
        has_null = F.exists(items, lambda x: F.coalesce(F.is_variant_null(x), F.lit(True)))
        bad = F.exists(vals, lambda x: x.isNull())
        return vals, has_null, bad

    def date_array(self, name: str) -> tuple[Column, Column]:
        items = F.try_variant_get(self._get(name), "$", "array<variant>")
        vals = F.transform(items, lambda x: F.try_to_date(F.try_variant_get(x, "$", "string")))
        return vals, F.exists(vals, lambda x: x.isNull())
