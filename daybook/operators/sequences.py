"""Raw sample -> fixed-length prepared example (SEQ-1..11, PRJ-3/4, FN-2..9).

Array form (default): every step is a higher-order function over the row's own
arrays (at most 31 elements), so preparation is row-local: no shuffle, no
Python, and it runs unchanged on a stream.

Semantics kept from the source pipeline:

* the running total follows array order; re-ordering by day comes after;
* a calendar day without a sale takes the previous sale day's values
  (forward fill); days before the first sale take the first sale day's values
  (back fill); only ``valid_day`` marks the real days;
* ``month`` and ``day`` are 0-based, ``last_valid_day`` is 1-based and is the
  day of the *last array element* (not the maximum);
* the target is month total / pack size, the same in all 31 places; a zero
  pack size gives +-inf (NaN for a zero total) instead of an error.

Every row gets ``error_class``/``error_message``: NULL for good rows, else the
first failing check in the source's code order (see ``_rules``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook import spec
from daybook.functions.parsing import TableFields, VariantFields
from daybook.functions.steps import inline_once, settled

RAW_KEYS = [
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
ERROR_COLUMNS = ["error_class", "error_message"]


CHUNK = 64


def _sum(values: Column) -> Column:
    """Sum of a list of longs (ANSI-safe: overflow or a NULL element -> NULL)."""
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, b: F.try_add(a, b))


def _running_total(qty: Column) -> Column:
    """SEQ-1: cumulative sum in array order.

    A list of up to ``CHUNK`` elements is summed from its start for each of them. Elements of a longer one are
    summed within chunks, on top of the chunk's
    start, so the work per element is bounded whatever the list's length. The
    starts are bound by a one-element ``transform`` so that they are computed
    once a row.
    """
    chunk = lambda c: F.slice(qty, c * CHUNK + 1, CHUNK)
    sums = F.transform(F.sequence(F.lit(0), (F.size(qty) / CHUNK).cast("int")), lambda c: _sum(chunk(c)))
    starts = lambda s: F.transform(s, lambda _x, c: _sum(F.slice(s, 1, c)))

    def within(start: Column) -> Column:
        first = lambda i: (i / CHUNK).cast("int")
        return F.transform(
            qty, lambda _x, i: F.try_add(F.get(start, first(i)), _sum(F.slice(qty, first(i) * CHUNK + 1, i % CHUNK + 1)))
        )

    short = F.transform(qty, lambda _x, i: _sum(F.slice(qty, F.lit(1), i + 1)))
    long = F.get(F.transform(F.array(F.get(F.transform(F.array(sums), starts), 0)), within), 0)
    return F.when(F.size(qty) <= CHUNK, short).otherwise(long)


def _array_total(qty: Column) -> Column:
    """SEQ-2: the sequence total."""
    return _sum(qty)


def packs(total: Column, pack_size: Column) -> Column:
    """SEQ-3: total / pack_size as pandas computes it (x/0 -> +-inf, 0/0 -> NaN)."""
    t = total.cast("double")
    return (
        F.when(pack_size.isNull() | total.isNull(), F.lit(None).cast("double"))
        .when(pack_size != 0, t / pack_size)
        .when(t > 0, F.lit(float("inf")))
        .when(t < 0, F.lit(float("-inf")))
        .otherwise(F.lit(float("nan")))
    )


def day_runs(days: Column) -> Column:
    """SEQ-6/9/10: the sale days in calendar order, each with its 1-based array position and the calendar
    days 1..31 that its values fill: those from it up to the next sale day, of the first one also those before it."""
    ordered = F.sort_array(F.transform(days, lambda d, i: F.struct(d.alias("day"), (i + 1).alias("at"))))

    def runs(o: Column) -> Column:
        return F.transform(o, lambda x, i: F.struct(
            x["at"].alias("at"),
            F.when(i == 0, x["day"] - 1).otherwise(0).cast("int").alias("before"),
            (F.coalesce(F.get(o, i + 1)["day"], F.lit(spec.SEQ_LEN + 1)) - x["day"]).cast("int").alias("filled"),
        ))

    return F.get(F.transform(F.array(ordered), runs), 0)


def valid_mask(runs: Column) -> Column:
    """SEQ-7: 1 on calendar days that had a sale, else 0."""
    zeros = lambda n: F.array_repeat(F.lit(0).cast("bigint"), n)
    one = F.array(F.lit(1).cast("bigint"))
    return F.flatten(F.transform(runs, lambda r: F.concat(zeros(r["before"]), one, zeros(r["filled"] - 1))))


def spread(values: Column, runs: Column, to: str = "double") -> Column:
    """``values`` on the calendar days that they fill."""
    return F.flatten(F.transform(runs, lambda r: F.array_repeat(F.get(values, r["at"] - 1).cast(to), r["before"] + r["filled"])))


def _fields_for(raw: DataFrame):
    if "v" in raw.columns and isinstance(raw.schema["v"].dataType, T.VariantType):
        return VariantFields("v")
    return TableFields(raw.schema)


def _typed(raw: DataFrame, fields, keep: list[str]) -> DataFrame:
    """Stage 1: read every field once, Python-style, keeping validity flags."""
    qty, qty_null, qty_bad = fields.long_array("daily_bottles_sold_arr")
    dates, dates_bad = fields.date_array("dates_arr")
    cols = [F.col(c) for c in keep]
    cols += [
        fields.string("year_month").alias("_ym"),
        fields.long_value("item_number").alias("_item_id"),
        fields.string("item_description").alias("_desc"),
        *[fields.double_value(f).alias(f"_{f}") for f in spec.SCALAR_FLOAT_FEATURES],
        fields.long_value("last_valid_day").alias("_lvd_in")
        if isinstance(fields, VariantFields) or "last_valid_day" in raw.columns
        else F.lit(None).cast("bigint").alias("_lvd_in"),
        qty.alias("_qty"),
        qty_null.alias("_qty_null"),
        qty_bad.alias("_qty_bad"),
        dates.alias("_dates"),
        dates_bad.alias("_dates_bad"),
    ]
    flags = {}
    for name in RAW_KEYS + ["last_valid_day"]:
        flags[f"_p_{name}"] = fields.present(name)
        flags[f"_n_{name}"] = fields.is_null(name)
        flags[f"_c_{name}"] = fields.wrong_container(name)
    flags["_s_year_month"] = fields.is_string("year_month")
    flags["_s_item_description"] = fields.is_string("item_description")
    flags["_a_daily_bottles_sold_arr"] = fields.is_array("daily_bottles_sold_arr")
    flags["_a_dates_arr"] = fields.is_array("dates_arr")
    flags["_obj"] = fields.element_is_object() if isinstance(fields, VariantFields) else F.lit(True)
    cols += [c.alias(n) for n, c in flags.items()]
    if isinstance(fields, VariantFields):
        raw = fields.extract(raw, RAW_KEYS + ["last_valid_day"])
    return raw.select(*cols)


def _rules() -> list[tuple[Column, str, Column]]:
    """Ordered checks; the first that holds names the row's error class."""
    c = F.col
    rules: list[tuple[Column, str, Column]] = []

    def add(cond, cls, msg):
        rules.append((cond, cls, msg if isinstance(msg, Column) else F.lit(msg)))

    add(~c("_obj"), "TypeErrors", "element is not an object")
    add(~c("_p_year_month"), "KeyErrors", "'year_month'")
    add(c("_n_year_month") | ~c("_s_year_month"), "other_errors", "year_month is not text")
    add(F.size(c("_parts")) != 2, "ValueErrors", "year_month does not split into year and month")
    add(~c("_p_item_number"), "KeyErrors", "'item_number'")
    add(c("_n_item_number") | c("_c_item_number"), "TypeErrors", "item_number is null")
    add(c("_item_id").isNull(), "ValueErrors", "item_number is not an integer")
    add(c("_year").isNull(), "ValueErrors", "year is not an integer")
    add(c("_month1").isNull(), "ValueErrors", "month is not an integer")
    add(~c("_p_item_description"), "KeyErrors", "'item_description'")
    add(c("_p_last_valid_day") & (c("_n_last_valid_day") | c("_c_last_valid_day")), "TypeErrors", "last_valid_day is null")
    add(c("_p_last_valid_day") & c("_lvd_in").isNull(), "ValueErrors", "last_valid_day is not an integer")
    for f in spec.SCALAR_FLOAT_FEATURES:
        add(~c(f"_p_{f}"), "KeyErrors", f"'{f}'")
        add(c(f"_n_{f}") | c(f"_c_{f}"), "TypeErrors", f"{f} is null")
        add(c(f"_{f}").isNull(), "ValueErrors", f"{f} is not a number")
    q = "daily_bottles_sold_arr"
    add(~c(f"_p_{q}"), "KeyErrors", f"'{q}'")
    add(c(f"_n_{q}") | c("_qty_null"), "TypeErrors", "a quantity is null")
    # the source would spread one number over all dates; here a list is required
    add(~c(f"_a_{q}"), "TypeErrors", "quantities are not a list")
    add(c("_qty_bad"), "ValueErrors", "a quantity is not an integer")
    d = "dates_arr"
    add(~c(f"_p_{d}"), "KeyErrors", f"'{d}'")
    add(c(f"_n_{d}"), "other_errors", "dates_arr is null")
    add(~c(f"_a_{d}") | c("_dates_bad"), "ValueErrors", "a date does not parse")
    add(F.size(c("_qty")) != F.size(c("_dates")), "ValueErrors", "dates and quantities differ in length")
    add(F.size(c("_qty")) == 0, "other_errors", "no sale days")
    add(F.size(F.array_distinct(c("_days"))) != F.size(c("_days")), "ValueErrors", "a day of month occurs twice")
    add(F.exists(c("_cumu"), lambda x: x.isNull()), "other_errors", "the running total does not fit 64 bits")
    sample_id = F.concat_ws("_", c("_item_id"), c("_year"), c("_month1") - 1)
    add(c("_n_item_description"), "AssertionErrors", F.concat(sample_id, F.lit(" is missing item_description")))
    add(~c("_s_item_description"), "AssertionErrors", F.concat(sample_id, F.lit(": item_description should be string")))
    return rules


def _classify(rules) -> tuple[Column, Column]:
    cls, msg = None, None
    for cond, name, text in rules:
        cond = F.coalesce(cond, F.lit(False))
        cls = F.when(cond, F.lit(name)) if cls is None else cls.when(cond, F.lit(name))
        msg = F.when(cond, text) if msg is None else msg.when(cond, text)
    return cls, msg


def prepare_samples(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Raw samples -> prepared features + ``error_class``/``error_message``.

    ``raw`` is either typed columns named like the raw-sample keys (the rollup
    output, or any table) or one VARIANT column ``v`` per JSON element.
    ``keep`` lists extra input columns carried through (e.g. a raw JSON text).
    """
    keep = list(keep or [])
    fields = _fields_for(raw)
    typed = settled(_typed(raw, fields, keep))
    parts = F.split(F.col("_ym"), "-", -1)
    stage2 = typed.select(
        "*",
        parts.alias("_parts"),
        F.get(parts, 0).try_cast("bigint").alias("_year"),
        F.get(parts, 1).try_cast("bigint").alias("_month1"),
        F.transform("_dates", lambda x: F.dayofmonth(x).cast("bigint")).alias("_days"),
        _running_total(F.col("_qty")).alias("_cumu"),
        _array_total(F.col("_qty")).alias("_total"),
    )
    cls, msg = _classify(_rules())
    stage3 = settled(stage2.select("*", day_runs(F.col("_days")).alias("_runs"))).select("*", cls.alias("error_class"), msg.alias("error_message"))
    out = [F.col(c) for c in keep] + [
        F.col("_desc").alias("item_description"),
        F.col("_item_id").alias("item_id"),
        F.col("_year").alias("year"),
        (F.col("_month1") - 1).alias("month"),
        F.get(F.col("_days"), F.size("_days") - 1).alias("last_valid_day"),
        *[F.col(f"_{f}").alias(f) for f in spec.SCALAR_FLOAT_FEATURES],
        F.sequence(F.lit(0), F.lit(spec.SEQ_LEN - 1)).cast("array<bigint>").alias("day"),
        valid_mask(F.col("_runs")).alias("valid_day"),
        spread(F.col("_cumu"), F.col("_runs")).alias("cumu_bottles_sold"),
        spread(F.col("_qty"), F.col("_runs")).alias("daily_bottles_sold"),
        F.array_repeat(packs(F.col("_total"), F.col("_pack_size")), spec.SEQ_LEN).alias("total_packs_sold"),
        *ERROR_COLUMNS,
    ]
    return stage3.select(*out)


def good_rows(prepared: DataFrame) -> DataFrame:
    """FLT-2: rows whose preparation succeeded, in the 14-column layout."""
    return prepared.where(F.col("error_class").isNull()).select(*spec.FEATURE_NAMES)


def prepare(raw: DataFrame) -> DataFrame:
    """SEQ-11: the whole chain for good rows only."""
    return good_rows(prepare_samples(raw))


def explode_days(prepared: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Long form of the five sequences: one row per example and calendar day.

    Used to compare with SQL and as the model's row layout.
    """
    keys = keys if keys is not None else [c for c in prepared.columns if c not in spec.SEQUENCE_FEATURES]
    return inline_once(prepared, keys, F.arrays_zip(*[F.col(c) for c in spec.SEQUENCE_FEATURES]))


def padded_long_window(raw: DataFrame) -> DataFrame:
    """Window form of SEQ-1..10 on typed raw samples (good rows), long layout.

    Real days and padding days (the calendar days without a sale) are stacked
    and filled with window functions over (item, month) ordered by day. The
    groups hold exactly 31 rows, and the rollup's exchange already clusters
    the input by (item_number, year_month). Same rows as
    ``explode_days(prepare(raw))``; used to cross-check the array form.
    """
    part = ["item_number", "year_month"]
    parts = F.split("year_month", "-", -1)
    header = raw.select(
        *part,
        "item_description",
        *spec.SCALAR_FLOAT_FEATURES,
        F.col("item_number").try_cast("bigint").alias("item_id"),
        F.get(parts, 0).try_cast("bigint").alias("year"),
        (F.get(parts, 1).try_cast("bigint") - 1).alias("month"),
        F.dayofmonth(F.get("dates_arr", F.size("dates_arr") - 1)).cast("bigint").alias("last_valid_day"),
        "dates_arr",
        "daily_bottles_sold_arr",
    )
    # the windows sort narrow rows: a sample's other columns go with its first sale day alone
    statics = [c for c in header.columns if c not in (*part, "dates_arr", "daily_bottles_sold_arr")]
    header = header.select(*part, F.struct(*statics).alias("of"), "dates_arr", "daily_bottles_sold_arr")
    nothing = F.lit(None).cast(header.schema["of"].dataType)
    real = header.select(
        *part,
        "of",
        F.posexplode(F.arrays_zip(F.col("dates_arr").alias("d"), F.col("daily_bottles_sold_arr").alias("q"))).alias(
            "pos", "z"
        ),
    ).select(*part, F.when(F.col("pos") == 0, F.col("of")).alias("of"), F.dayofmonth("z.d").cast("bigint").alias("dom"), F.col("z.q").alias("qty"), "pos")
    in_order = Window.partitionBy(*part).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    real = real.withColumn("cumu", F.sum("qty").over(in_order)).drop("pos")
    calendar = F.sequence(F.lit(1), F.lit(spec.SEQ_LEN)).cast("array<bigint>")
    missing = F.array_except(calendar, F.transform("dates_arr", lambda d: F.dayofmonth(d).cast("bigint")))
    pad = header.select(
        *part, nothing.alias("of"), F.explode(missing).alias("dom"), F.lit(None).cast("bigint").alias("qty"), F.lit(None).cast("bigint").alias("cumu")
    )
    by_day = Window.partitionBy(*part).orderBy("dom")
    upto = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = by_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def filled(c):
        return F.coalesce(F.last(c, ignorenulls=True).over(upto), F.first(c, ignorenulls=True).over(whole)).cast("double")

    rows = real.unionByName(pad)
    one = rows.select(
        F.first("of", ignorenulls=True).over(whole).alias("of"),
        (F.col("dom") - 1).alias("day"),
        F.col("qty").isNotNull().cast("bigint").alias("valid_day"),
        filled("cumu").alias("cumu_bottles_sold"),
        filled("qty").alias("daily_bottles_sold"),
        F.sum("qty").over(whole).alias("total"),
    )
    return one.select(
        *[F.col(f"of.{c}").alias(c) for c in ("item_description", "item_id", "year", "month", "last_valid_day", *spec.SCALAR_FLOAT_FEATURES)],
        *[c for c in one.columns if c not in ("of", "total")],
        packs(F.col("total"), F.col("of.pack_size")).alias("total_packs_sold"),
    )
