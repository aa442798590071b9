"""Registered queries: one Spark callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory, and, where SQL can express it, its DuckDB twin.

Every query reads the driver's tables (``lineitem`` through the sales adapter)
over the whole table. Array results are returned exploded (one row per key and
day) so both engines compare scalar values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from daybook import spec
from daybook.functions.steps import inline_once, settled
from daybook.operators import layout, quality, scoring, training
from daybook.operators.mapping import input_count, map_and_quarantine
from daybook.operators.scaling import apply_minmax, fit_minmax, footer_columns, footer_stats, stats_frame
from daybook.operators.split import mark_split
from daybook.plans.train import examples_of_lines, run_train, split_folder
from daybook.sources import examples, interleaved
from daybook.operators.rollup import MEASURES, daily_item_sales, raw_samples
from daybook.operators.sequences import explode_days, good_rows, padded_long_window, prepare_samples
from daybook.plans import faults
from daybook.plans import predict as predict_plan
from daybook.plans import oracle as O
from daybook.session import ship_package, work_path
from daybook.sources.ndjson import parse_lines, read_lines
from daybook.sources.sales import date_window, events_sales, lineitem_sales, mark_sales

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# -- shared building blocks -------------------------------------------------


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return lineitem_sales(spark, sf_dir)


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return good_rows(prepare_samples(raw_samples(sales(spark, sf_dir))))


def window_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    window = date_window(sales(spark, sf_dir), O.WINDOW_START, O.WINDOW_END)
    return good_rows(prepare_samples(raw_samples(window)))


KEYS = ["item_id", "year", "month"]

# -- SRC-1, FLT-1, PRJ-1/2, AGG-1..6, SRT-1 ----------------------------------


@register("sales_scan", O.with_ctes(O.SALES) + "SELECT * FROM sales")
def q_sales_scan(spark, sf_dir):
    return sales(spark, sf_dir)


@register(
    "sales_window",
    O.with_ctes(O.SALES)
    + f"SELECT * FROM (SELECT * FROM sales) WHERE date BETWEEN DATE '{O.WINDOW_START}' AND DATE '{O.WINDOW_END}'",
)
def q_sales_window(spark, sf_dir):
    return date_window(sales(spark, sf_dir), O.WINDOW_START, O.WINDOW_END)


@register("daily_item_sales", O.with_ctes(O.SALES, O.daily_cte()) + "SELECT * FROM daily")
def q_daily_item_sales(spark, sf_dir):
    return daily_item_sales(sales(spark, sf_dir))


_MONTHLY_EXPLODED = """
SELECT d.item_number, d.year_month, m.item_description, m.cost, m.retail, m.volume_ml, m.pack_size,
       CAST(row_number() OVER (PARTITION BY d.item_number, d.year_month ORDER BY d.date) AS BIGINT) AS pos,
       d.date, d.daily_bottles_sold
FROM daily d JOIN monthly m ON d.item_number = m.item_number AND d.year_month = m.year_month"""


def _monthly_exploded(raw: DataFrame) -> DataFrame:
    zipped = F.arrays_zip(F.col("dates_arr").alias("date"), F.col("daily_bottles_sold_arr").alias("qty"))
    return raw.select(
        "item_number", "year_month", "item_description", *MEASURES, F.posexplode(zipped).alias("p", "z")
    ).select(
        "item_number",
        "year_month",
        "item_description",
        *MEASURES,
        (F.col("p") + 1).cast("bigint").alias("pos"),
        F.col("z.date").alias("date"),
        F.col("z.qty").alias("daily_bottles_sold"),
    )


@register("monthly_sequences", O.FULL + _MONTHLY_EXPLODED)
def q_monthly_sequences(spark, sf_dir):
    return _monthly_exploded(raw_samples(sales(spark, sf_dir)))


@register("window_sequences", O.WINDOW + _MONTHLY_EXPLODED)
def q_window_sequences(spark, sf_dir):
    """The predict-mode source: the rollup over a date window only."""
    window = date_window(sales(spark, sf_dir), O.WINDOW_START, O.WINDOW_END)
    return _monthly_exploded(raw_samples(window))


# -- PRJ-3/4, SEQ-1..11 -------------------------------------------------------


@register("padded_sequences", O.FULL + f"SELECT {O.PADDED_COLS} FROM padded")
def q_padded_sequences(spark, sf_dir):
    return explode_days(prepared(spark, sf_dir))


@register(
    "sequence_header",
    O.FULL
    + """
SELECT DISTINCT item_description, item_id, year, month, last_valid_day, volume_ml, pack_size, cost, retail,
       concat_ws('_', item_id, year, month) AS sample_id
FROM padded""",
)
def q_sequence_header(spark, sf_dir):
    p = prepared(spark, sf_dir)
    return p.select(
        "item_description",
        *KEYS,
        "last_valid_day",
        "volume_ml",
        "pack_size",
        "cost",
        "retail",
        F.concat_ws("_", *KEYS).alias("sample_id"),
    )


def _padded_view(name: str, cols: list[str]):
    sql = O.FULL + f"SELECT {', '.join(KEYS + cols)} FROM padded"

    @register(name, sql)
    def q(spark, sf_dir):
        return explode_days(prepared(spark, sf_dir), KEYS).select(*KEYS, *cols)

    q.__name__ = f"q_{name}"
    return q


_padded_view("running_total", ["day", "cumu_bottles_sold"])
_padded_view("densified_days", ["day", "daily_bottles_sold"])
_padded_view("valid_mask", ["day", "valid_day"])
_padded_view("ffill_bfill", ["day", "valid_day", "daily_bottles_sold", "cumu_bottles_sold"])


@register("last_valid_day", O.FULL + "SELECT DISTINCT item_id, year, month, last_valid_day FROM padded")
def q_last_valid_day(spark, sf_dir):
    return prepared(spark, sf_dir).select(*KEYS, "last_valid_day")


# -- SRC-2/3, UDF-1, FLT-2, AGG-8, VAL-1..4 -----------------------------------

_LINES_CACHE: dict[tuple[str, str], str] = {}


def ndjson_path(spark: SparkSession, sf_dir: str) -> str:
    """Write the fault-injected JSON lines (derived from lineitem) once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LINES_CACHE:
        path = work_path(spark, "ndjson")
        faults.json_lines(raw_samples(sales(spark, sf_dir))).write.mode("overwrite").text(path)
        _LINES_CACHE[key] = path
    return _LINES_CACHE[key]


def json_pipeline(spark: SparkSession, sf_dir: str):
    """Text scan -> parse (stage 'parse') -> prepare (stage 'prepare')."""
    lines = read_lines(spark, ndjson_path(spark, sf_dir))
    elements, marked = parse_lines(lines)
    prepared_json = prepare_samples(elements, keep=["line", "v"])
    return marked, prepared_json


def _codes_case(stage_or_class: int) -> str:
    whens = " ".join(f"WHEN {code} THEN '{exp[stage_or_class]}'" for code, exp in sorted(faults.EXPECTED.items()))
    return f"CASE r {whens} END"


_FAILING = ", ".join(str(c) for c in sorted(faults.EXPECTED))
_PREPARE_FAILING = ", ".join(str(c) for c, e in sorted(faults.EXPECTED.items()) if e[0] == "prepare")
_CODED = O.with_ctes(O.SALES, O.daily_cte(), O.MONTHLY, O.PADDED.strip().rstrip(","), O.CODED)


@register(
    "ndjson_parse",
    _CODED
    + f"""
SELECT p.item_description, p.item_id, CASE WHEN c.r = {faults.NO_YEAR} THEN 0 ELSE p.year END AS year, p.month, p.last_valid_day, p.volume_ml,
       CASE WHEN c.r = {faults.ZERO_PACK} THEN 0.0 ELSE p.pack_size END AS pack_size,
       p.cost, p.retail, p.day, p.valid_day, p.cumu_bottles_sold, p.daily_bottles_sold,
       CASE WHEN c.r = {faults.ZERO_PACK} THEN (CASE WHEN p.total > 0 THEN 'inf'::DOUBLE
                                             WHEN p.total < 0 THEN '-inf'::DOUBLE ELSE 'nan'::DOUBLE END)
            ELSE p.total_packs_sold END AS total_packs_sold
FROM padded p JOIN coded c ON p.src_item = c.item_number AND p.src_ym = c.year_month
CROSS JOIN {O.TWICE}
WHERE c.r NOT IN ({_FAILING}) AND (dup.k = 1 OR c.r = {faults.LIST_LINE})""",
)
def q_ndjson_parse(spark, sf_dir):
    _, prepared_json = json_pipeline(spark, sf_dir)
    return explode_days(good_rows(prepared_json))


@register(
    "ndjson_quarantine",
    _CODED
    + f"""
SELECT stage, error_class, CAST(count(*) AS BIGINT) AS n
FROM (SELECT {_codes_case(0)} AS stage, {_codes_case(1)} AS error_class FROM coded WHERE r IN ({_FAILING}))
GROUP BY stage, error_class""",
)
def q_ndjson_quarantine(spark, sf_dir):
    marked, prepared_json = json_pipeline(spark, sf_dir)
    bad = quality.quarantine(marked, "parse", "line").unionByName(
        quality.quarantine(prepared_json, "prepare", F.to_json("v"))
    )
    return bad.groupBy("stage", "error_class").agg(F.count(F.lit(1)).alias("n"))


def _count_sql() -> str:
    def cnt(cond: str) -> str:
        return f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT)"

    parse_cls = ", ".join(
        f"{cnt('r = 0') if name == 'ValueErrors' else 'CAST(0 AS BIGINT)'} AS {name}" for name in spec.ERROR_CLASSES
    )
    prep_cls = []
    for name in spec.ERROR_CLASSES:
        codes = [str(c) for c, e in faults.EXPECTED.items() if e == ("prepare", name)]
        prep_cls.append(f"{cnt('r IN (' + ', '.join(codes) + ')') if codes else 'CAST(0 AS BIGINT)'} AS {name}")
    return (
        _CODED
        + f"""
SELECT 'parse' AS stage, CAST(count(*) AS BIGINT) AS n_elements, {cnt('r = 0')} AS failed_elements, {parse_cls}
FROM coded
UNION ALL
SELECT 'prepare' AS stage, {cnt('r <> 0')} + {cnt(f'r = {faults.LIST_LINE}')} AS n_elements,
       {cnt(f'r IN ({_PREPARE_FAILING})')} AS failed_elements, {', '.join(prep_cls)}
FROM coded"""
    )


@register("error_counts", _count_sql())
def q_error_counts(spark, sf_dir):
    marked, prepared_json = json_pipeline(spark, sf_dir)
    return quality.error_counts(marked, "parse").unionByName(quality.error_counts(prepared_json, "prepare"))


def _json_fields(value):
    import json

    return json.loads(value)


@register(
    "map_and_quarantine",
    _CODED
    + f"""
SELECT CASE WHEN r IN (0, 14, 15) THEN NULL WHEN r = 4 THEN 'x' || item_number ELSE item_number END AS item_number,
       CASE WHEN r IN (0, 14, 15, 2) THEN NULL WHEN r = 3 THEN substr(year_month, 1, 4)
            WHEN r = {faults.NO_YEAR} THEN '0000' || substr(year_month, 5) ELSE year_month END AS year_month,
       CASE WHEN r = 0 THEN 'ValueErrors' END AS error_class
FROM coded CROSS JOIN {O.TWICE}
WHERE dup.k = 1 OR r = {faults.LIST_LINE}""",
)
def q_map_and_quarantine(spark, sf_dir):
    lines = read_lines(spark, ndjson_path(spark, sf_dir))
    out_schema = T.StructType([T.StructField("item_number", T.StringType()), T.StructField("year_month", T.StringType())])
    mapped = map_and_quarantine(lines, _json_fields, out_schema, ["value"])
    return mapped.where("output >= 0").select("item_number", "year_month", "error_class")


def _quantities(value):
    import json

    return [{"n": int(q)} for q in json.loads(value)["daily_bottles_sold_arr"]]


_NOT_MAPPED = f"0, 6, {faults.LIST_LINE}, 14, 15"


@register(
    "map_counts",
    _CODED
    + f"""
, days AS (SELECT item_number, year_month, count(*) AS n FROM daily GROUP BY item_number, year_month)
SELECT CAST(count(*) AS BIGINT) AS n_elements,
       CAST(count(*) FILTER (WHERE r IN ({_NOT_MAPPED})) AS BIGINT) AS failed_elements,
       CAST(sum(CASE WHEN r IN ({_NOT_MAPPED}, 9) THEN 0 WHEN r = 10 THEN n + 1 WHEN r = 19 THEN 2 ELSE n END) AS BIGINT) AS n_results,
       max(CASE WHEN r = 19 THEN 9223372036854775807 END) AS largest
FROM coded JOIN days USING (item_number, year_month)""",
)
def q_map_counts(spark, sf_dir):
    """A function that returns lists: inputs are counted, not outputs, and longs stay exact beside failures."""
    lines = read_lines(spark, ndjson_path(spark, sf_dir))
    mapped = map_and_quarantine(lines, _quantities, T.StructType([T.StructField("n", T.LongType())]), ["value"])
    return mapped.agg(
        input_count().alias("n_elements"),
        F.count_if(F.col("error_class").isNotNull()).alias("failed_elements"),
        F.count_if(F.col("error_class").isNull() & (F.col("output") >= 0)).alias("n_results"),
        F.max("n").alias("largest"),
    )


@register(
    "table_last_valid_day",
    O.FULL + "SELECT DISTINCT item_id, year, month, last_valid_day, CAST(NULL AS VARCHAR) AS error_class FROM padded",
)
def q_table_last_valid_day(spark, sf_dir):
    """Table input that brings its own last_valid_day, which preparation reads and replaces."""
    raw = raw_samples(sales(spark, sf_dir)).withColumn("last_valid_day", F.lit(1).cast("bigint"))
    return prepare_samples(raw).select(*KEYS, "last_valid_day", "error_class")


@register(
    "sales_quarantine",
    """
SELECT CASE WHEN l_orderkey % 97 = 0 THEN 'ValueErrors' END AS error_class,
       CASE WHEN l_orderkey % 97 = 0 THEN 'date is not a date' END AS error_message,
       CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN l_orderkey % 97 = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) END) AS BIGINT) AS bottles
FROM lineitem GROUP BY ALL""",
)
def q_sales_quarantine(spark, sf_dir):
    """Sales as text with dates that don't exist: such lines are marked and the others used."""
    text = F.when(F.col("l_orderkey") % 97 == 0, F.lit("2020-13-01")).otherwise(F.col("l_shipdate").cast("date").cast("string"))
    source = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_suppkey").cast("string").alias("item_number"), F.lit("x").alias("item_description"),
        *[F.lit(1.0).alias(c) for c in ("state_bottle_cost", "state_bottle_retail")],
        *[F.lit(1).alias(c) for c in ("bottle_volume_ml", "pack")],
        text.alias("date"), F.col("l_quantity").cast("bigint").cast("string").alias("bottles_sold"),
    )
    used = F.when(F.col("error_class").isNull(), F.col("bottles_sold")).otherwise(0)
    return mark_sales(source).groupBy("error_class", "error_message").agg(F.count("*").alias("n"), F.sum(used).alias("bottles"))


_TYPED_FAULTS = {2: "other_errors", 3: "ValueErrors", 4: "ValueErrors", 9: "other_errors", 10: "ValueErrors", 11: "AssertionErrors"}


@register(
    "prepared_quarantine",
    _CODED
    + f"""
SELECT CASE WHEN r = 4 THEN 'x' || item_number ELSE item_number END AS item_number,
       CASE WHEN r = 2 THEN NULL WHEN r = 3 THEN substr(year_month, 1, 4) ELSE year_month END AS year_month,
       CASE r {' '.join(f"WHEN {c} THEN '{k}'" for c, k in _TYPED_FAULTS.items())} END AS error_class
FROM coded WHERE r IN ({', '.join(str(c) for c in _TYPED_FAULTS)})""",
)
def q_prepared_quarantine(spark, sf_dir):
    raw = raw_samples(sales(spark, sf_dir)).withColumn("_r", faults.fault_code(F.col("item_number"), F.col("year_month")))
    r = F.col("_r")
    faulty = raw.withColumns(
        {
            "item_number": F.when(r == 4, F.concat(F.lit("x"), "item_number")).otherwise(F.col("item_number")),
            "year_month": F.when(r == 2, F.lit(None).cast("string"))
            .when(r == 3, F.substring("year_month", 1, 4))
            .otherwise(F.col("year_month")),
            "dates_arr": F.when(r == 9, F.array().cast("array<date>"))
            .when(r == 10, F.concat("dates_arr", F.array(F.get("dates_arr", 0))))
            .otherwise(F.col("dates_arr")),
            "daily_bottles_sold_arr": F.when(r == 9, F.array().cast("array<bigint>"))
            .when(r == 10, F.concat("daily_bottles_sold_arr", F.array(F.get("daily_bottles_sold_arr", 0))))
            .otherwise(F.col("daily_bottles_sold_arr")),
            "item_description": F.when(r == 11, F.lit(None).cast("string")).otherwise(F.col("item_description")),
        }
    ).drop("_r")
    marked = prepare_samples(faulty, keep=["item_number", "year_month"])
    return marked.where(F.col("error_class").isNotNull()).select("item_number", "year_month", "error_class")


@register(
    "validate_examples",
    _CODED
    + """
SELECT s.item_id, s.year, s.month,
       CASE WHEN c.r IN (5, 9, 11) THEN 'AssertionErrors' END AS error_class,
       CASE WHEN c.r = 11 THEN concat_ws('_', s.item_id, s.year, s.month) || ' is missing item_description'
            WHEN c.r = 5 THEN concat_ws('_', s.item_id, s.year, s.month) || ' is missing pack_size'
            WHEN c.r = 9 THEN concat_ws('_', s.item_id, s.year, s.month)
                              || ': daily_bottles_sold shape (30,) but should be (31,)' END AS error_message
FROM (SELECT DISTINCT item_id, year, month, src_item, src_ym FROM padded) s
JOIN coded c ON s.src_item = c.item_number AND s.src_ym = c.year_month""",
)
def q_validate_examples(spark, sf_dir):
    p = prepared(spark, sf_dir)
    r = faults.fault_code(F.col("item_id"), F.concat_ws("-", F.col("year"), F.lpad((F.col("month") + 1).cast("string"), 2, "0")))
    broken = p.withColumn("_r", r).withColumns(
        {
            "item_description": F.when(F.col("_r") == 11, F.lit(None).cast("string")).otherwise(F.col("item_description")),
            "pack_size": F.when(F.col("_r") == 5, F.lit(None).cast("double")).otherwise(F.col("pack_size")),
            "daily_bottles_sold": F.when(F.col("_r") == 9, F.slice("daily_bottles_sold", 1, 30)).otherwise(
                F.col("daily_bottles_sold")
            ),
        }
    )
    return quality.validate_examples(broken.drop("_r")).select(*KEYS, "error_class", "error_message")


# -- AGG-7, SCL-1..4, PRJ-5, SPL-1, SNK-1/3, SRC-4/5 ----------------------------

_SCALARS = ["item_description", "last_valid_day", "cost", "retail"]


@register("minmax_stats", O.FULL_STATS + "SELECT * FROM stats")
def q_minmax_stats(spark, sf_dir):
    return stats_frame(prepared(spark, sf_dir))


_MINMAX_NAN = """
SELECT min(volume_ml) FILTER (WHERE item_id % 5 <> 0) AS volume_ml_min, max(volume_ml) FILTER (WHERE item_id % 5 <> 0) AS volume_ml_max,
       min(pack_size) AS pack_size_min, max(pack_size) AS pack_size_max FROM padded"""


@register("minmax_footer", O.FULL + _MINMAX_NAN)
def q_minmax_footer(spark, sf_dir):
    """AGG-7 from the footers of a written table, a fifth of whose items have NaN in one column."""
    odd = F.when(F.col("item_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("volume_ml").cast("double"))
    rows, path = prepared(spark, sf_dir).withColumn("volume_ml", odd), work_path(spark, "footers")
    rows.withColumns(footer_columns()).write.parquet(path)
    found = footer_stats(spark, path)
    return spark.createDataFrame([tuple(found.first())], found.schema)


@register(
    "minmax_scaled",
    O.FULL_STATS
    + f"""
SELECT DISTINCT item_id, year, month, {', '.join(_SCALARS)},
       {O.scaled_sql('volume_ml')} AS volume_ml, {O.scaled_sql('pack_size')} AS pack_size
FROM padded CROSS JOIN stats""",
)
def q_minmax_scaled(spark, sf_dir):
    p = prepared(spark, sf_dir)
    return apply_minmax(p, fit_minmax(p)).select(*KEYS, *_SCALARS, "volume_ml", "pack_size")


@register(
    "train_test_split",
    O.FULL
    + f"""
SELECT DISTINCT item_id, year, month,
       CASE WHEN make_date(CAST(year AS INTEGER), CAST(month + 1 AS INTEGER), 1) >= DATE '{O.SPLIT_DATE}'
            THEN 'test' ELSE 'train' END AS split
FROM padded""",
)
def q_train_test_split(spark, sf_dir):
    return mark_split(prepared(spark, sf_dir), O.SPLIT_DATE).select(*KEYS, "split")


_ROUNDTRIP_SQL = (
    O.FULL_STATS
    + f"""
SELECT CASE WHEN make_date(CAST(year AS INTEGER), CAST(month + 1 AS INTEGER), 1) >= DATE '{O.SPLIT_DATE}'
            THEN 'test' ELSE 'train' END AS split,
       item_description, item_id, year, month, last_valid_day,
       CAST(CAST({O.scaled_sql('volume_ml')} AS FLOAT) AS DOUBLE) AS volume_ml,
       CAST(CAST({O.scaled_sql('pack_size')} AS FLOAT) AS DOUBLE) AS pack_size,
       CAST(CAST(cost AS FLOAT) AS DOUBLE) AS cost, CAST(CAST(retail AS FLOAT) AS DOUBLE) AS retail,
       day, valid_day,
       CAST(CAST(cumu_bottles_sold AS FLOAT) AS DOUBLE) AS cumu_bottles_sold,
       CAST(CAST(daily_bottles_sold AS FLOAT) AS DOUBLE) AS daily_bottles_sold,
       CAST(CAST(total_packs_sold AS FLOAT) AS DOUBLE) AS total_packs_sold
FROM padded CROSS JOIN stats"""
)


def _roundtrip(spark, sf_dir, fmt, shards=None):
    dataset = work_path(spark, f"dataset-{fmt}")
    run_train(spark, sales(spark, sf_dir), dataset, O.SPLIT_DATE, shards, fmt)
    parts = [
        examples.read_examples(spark, dataset, s if shards else split_folder(s), fmt).withColumn("split", F.lit(s))
        for s in (spec.TRAIN_PREFIX, spec.TEST_PREFIX)
    ]
    back = explode_days(parts[0].unionByName(parts[1]))
    floats = [f.name for f in spec.FEATURES if f.kind == "float"]
    return back.withColumns({c: F.col(c).cast("double") for c in floats})


@register("example_roundtrip", _ROUNDTRIP_SQL)
def q_example_roundtrip(spark, sf_dir):
    """Full train job (gzip JSON shards), then read every shard back."""
    return _roundtrip(spark, sf_dir, "json", {spec.TRAIN_PREFIX: spec.TRAIN_SHARDS})


@register("binary_roundtrip", _ROUNDTRIP_SQL)
def q_binary_roundtrip(spark, sf_dir):
    """The same through a binary format, one folder a split."""
    return _roundtrip(spark, sf_dir, "orc")


@register("json_examples", O.FULL + f"SELECT {O.PADDED_COLS} FROM padded")
def q_json_examples(spark, sf_dir):
    """Train job's examples from JSON lines without faults: the same as from the table."""
    path = work_path(spark, "clean-lines")
    raw_samples(sales(spark, sf_dir)).select(F.to_json(F.struct("*")).alias("value")).write.text(path)
    marked = examples_of_lines(read_lines(spark, path))
    return explode_days(marked.where("stage IS NULL").select(*spec.FEATURE_NAMES))


@register(
    "scaler_reload",
    O.WINDOW_STATS
    + f"""
SELECT DISTINCT item_id, year, month,
       {O.scaled_sql('volume_ml')} AS volume_ml, {O.scaled_sql('pack_size')} AS pack_size
FROM padded CROSS JOIN stats""",
)
def q_scaler_reload(spark, sf_dir):
    """Fit on the whole table, save, reload, apply to the prediction window."""
    dataset = work_path(spark, "transform")
    examples.save_minmax(spark, dataset, fit_minmax(prepared(spark, sf_dir)))
    reloaded = examples.load_minmax(spark, dataset)
    return apply_minmax(window_prepared(spark, sf_dir), reloaded).select(*KEYS, "volume_ml", "pack_size")


# -- PRJ-6/7, SEQ-12..14, SRT-2/3 ---------------------------------------------

_LAYOUT_COLS = ["valid_day", *spec.MODEL_TILED_FEATURES, *spec.MODEL_SEQUENCE_FEATURES]


@register(
    "model_layout",
    O.FULL
    + f"""
SELECT year, day AS step, CAST(1 AS INTEGER) AS feature_width, {', '.join(_LAYOUT_COLS)} FROM padded""",
)
def q_model_layout(spark, sf_dir):
    lay = layout.model_layout(prepared(spark, sf_dir))
    z = F.arrays_zip(*[F.col(c) for c in _LAYOUT_COLS])
    nested = [c for c in _LAYOUT_COLS if c != "valid_day"]
    rows = F.transform(
        z,
        lambda e, i: F.struct(
            i.cast("bigint").alias("step"),
            F.size(e["cost"]).alias("feature_width"),
            e["valid_day"].alias("valid_day"),
            *[F.get(e[c], 0).alias(c) for c in nested],
        ),
    )
    return inline_once(lay, ["year"], rows)


@register("feature_target_split", O.FULL + "SELECT item_id, year, month, day, total_packs_sold AS label FROM padded")
def q_feature_target_split(spark, sf_dir):
    split = layout.feature_target_split(prepared(spark, sf_dir))
    return split.select(
        "features.item_id", "features.year", "features.month", F.posexplode("label").alias("day", "label")
    ).withColumn("day", F.col("day").cast("bigint"))


@register(
    "step_matrix",
    O.FULL
    + "SELECT item_id, year, month, day AS step, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS step_{c}" for c in layout.STEP_FEATURES)
    + " FROM padded",
)
def q_step_matrix(spark, sf_dir):
    m = layout.step_matrix(prepared(spark, sf_dir))
    rows = F.transform(
        "steps",
        lambda r, i: F.struct(
            i.cast("bigint").alias("step"),
            *[F.get(r, k).alias(f"step_{c}") for k, c in enumerate(layout.STEP_FEATURES)],
        ),
    )
    return inline_once(m, KEYS, rows)


def _shuffle_sql(seed: int = 42) -> str:
    return f"substr(md5(concat_ws('|', '{seed}', {', '.join(KEYS)})), 1, 15)"


@register(
    "seeded_shuffle",
    O.FULL
    + f"""
SELECT *, CAST(row_number() OVER (ORDER BY shuffle_key, item_id, year, month) - 1 AS BIGINT) AS position
FROM (SELECT DISTINCT item_id, year, month, {_shuffle_sql()} AS shuffle_key FROM padded)""",
)
def q_seeded_shuffle(spark, sf_dir):
    """SRT-2: the table written in shuffled order; a row's position is its place in the files."""
    ordered, path = layout.seeded_shuffle(prepared(spark, sf_dir).select(*KEYS)), work_path(spark, "in-order")
    ordered.write.parquet(path)
    placed = interleaved.read_interleaved(spark, path, ordered.schema, cycle=1)
    return placed.select(*KEYS, "shuffle_key", F.col("position").cast("bigint"))


BATCH_SIZE = 32


@register(
    "batch_ids",
    O.FULL
    + f"""
, train AS (
  SELECT DISTINCT item_id, year, month FROM padded
  WHERE make_date(CAST(year AS INTEGER), CAST(month + 1 AS INTEGER), 1) < DATE '{O.SPLIT_DATE}'),
ordered AS (
  SELECT item_id, year, month, {_shuffle_sql()} AS shuffle_key FROM train),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY shuffle_key, item_id, year, month) - 1 AS position FROM ordered)
SELECT item_id, year, month, shuffle_key, CAST(position AS BIGINT) AS position,
       CAST(position // {BATCH_SIZE} AS BIGINT) AS batch_id
FROM numbered
WHERE position // {BATCH_SIZE} < (SELECT count(*) // {BATCH_SIZE} FROM train)""",
)
def q_batch_ids(spark, sf_dir):
    train = mark_split(prepared(spark, sf_dir), O.SPLIT_DATE).where(F.col("split") == spec.TRAIN_PREFIX)
    return layout.assign_batches(train.select(*KEYS), BATCH_SIZE).select(
        *KEYS, "shuffle_key", F.col("position").cast("bigint"), "batch_id"
    )


@register(
    "training_batches",
    O.FULL_STATS
    + f"""
, train AS (
  SELECT DISTINCT item_id, year, month FROM padded
  WHERE make_date(CAST(year AS INTEGER), CAST(month + 1 AS INTEGER), 1) < DATE '{O.SPLIT_DATE}'),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY {_shuffle_sql()}, item_id, year, month) - 1 AS position FROM train)
SELECT CAST(position // {BATCH_SIZE} AS BIGINT) AS batch_id, CAST(position AS BIGINT) AS position, item_id, year, month,
       day AS step, valid_day, CAST(CAST({O.scaled_sql('pack_size')} AS FLOAT) AS DOUBLE) AS pack_size,
       CAST(CAST(cumu_bottles_sold AS FLOAT) AS DOUBLE) AS cumu_bottles_sold,
       CAST(CAST(total_packs_sold AS FLOAT) AS DOUBLE) AS label
FROM numbered JOIN padded USING (item_id, year, month) CROSS JOIN stats
WHERE position // {BATCH_SIZE} < (SELECT count(*) // {BATCH_SIZE} FROM train)""",
)
def q_training_batches(spark, sf_dir):
    """Exported shards -> layout, target apart, shuffled batches with their features."""
    shards = examples.read_examples(spark, exported(spark, sf_dir), split_folder(spec.TRAIN_PREFIX))
    batches = layout.training_batches(shards, BATCH_SIZE)
    one = lambda c, i: F.get(F.get(F.col(f"features.{c}"), i), 0)
    steps = F.transform(F.sequence(F.lit(0), F.lit(spec.SEQ_LEN - 1)), lambda i: F.struct(
        i.cast("bigint").alias("step"),
        F.get(F.col("features.valid_day"), i).alias("valid_day"),
        one("pack_size", i).cast("double").alias("pack_size"),
        one("cumu_bottles_sold", i).cast("double").alias("cumu_bottles_sold"),
        F.get(F.get(F.col("label"), i), 0).cast("double").alias("label"),
    ))
    placed = settled(batches.withColumn("position", F.col("position").cast("bigint")))
    return inline_once(placed, ["batch_id", "position", *KEYS], steps)


# -- MDL-1..3, PRD-1..4, PRJ-8/9, SNK-4 ---------------------------------------

_DATASET_CACHE: dict[tuple[str, str], tuple[str, str]] = {}
_MODEL_CACHE: dict[tuple[str, str], tuple[str, str, dict]] = {}


def _exported(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Train job once per session: its data set, and where the model fitted on it is to lie."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _DATASET_CACHE:
        dataset, model_dir = predict_plan.model_paths(work_path(spark, "model-run"))
        run_train(spark, sales(spark, sf_dir), dataset, O.SPLIT_DATE)
        _DATASET_CACHE[key] = (dataset, model_dir)
    return _DATASET_CACHE[key]


def exported(spark: SparkSession, sf_dir: str) -> str:
    """The train job's data set, for queries that read examples or scaler and no model."""
    return _exported(spark, sf_dir)[0]


def trained(spark: SparkSession, sf_dir: str) -> tuple[str, str, dict]:
    """Train job + model fit once per session: (dataset dir, model dir, metrics)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODEL_CACHE:
        dataset, model_dir = _exported(spark, sf_dir)
        fit = predict_plan.run_fit(spark, dataset, model_dir)
        _MODEL_CACHE[key] = (dataset, model_dir, fit.metrics)
    return _MODEL_CACHE[key]


_TEST_DAYS = f"""
SELECT * FROM padded WHERE valid_day = 1
AND make_date(CAST(year AS INTEGER), CAST(month + 1 AS INTEGER), 1) >= DATE '{O.SPLIT_DATE}'"""


@register(
    "train_eval",
    O.FULL + f"SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_skipped, true AS finite, true AS beats_mean FROM ({_TEST_DAYS})",
)
def q_train_eval(spark, sf_dir):
    """Export, read back, train on train, save, reload, evaluate on test.

    Of a trained model this compares what is fixed: the rows it was judged on,
    that its errors are numbers, and that they are below the label's variance."""
    dataset, model_dir, _ = trained(spark, sf_dir)
    test = examples.read_examples(spark, dataset, split_folder(spec.TEST_PREFIX))
    metrics = training.regression_metrics(training.load(model_dir), test, F.var_pop(spec.TARGET).alias("spread"))
    return metrics.select(
        "n_rows", "n_skipped", (~F.isnan("mse") & (F.col("mse") < float("inf"))).alias("finite"), (F.col("mse") < F.col("spread")).alias("beats_mean")
    )


@register(
    "regression_metrics",
    O.FULL
    + f"""
, judged AS (SELECT CAST(2 * daily_bottles_sold + cumu_bottles_sold + month AS DOUBLE) - floor(total_packs_sold) AS err FROM ({_TEST_DAYS}))
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_skipped, sum(err * err) AS sum_squared, sum(abs(err)) AS sum_absolute,
       sum(err * err) / count(*) AS mse, sum(abs(err)) / count(*) AS mae
FROM judged""",
)
def q_regression_metrics(spark, sf_dir):
    """Errors of stored predictions; whole numbers, so that sums are exact in any order."""
    rows = training.long_rows(mark_split(prepared(spark, sf_dir), O.SPLIT_DATE).where(F.col("split") == spec.TEST_PREFIX))
    stored = work_path(spark, "judged")
    prediction = 2 * F.col("daily_bottles_sold") + F.col("cumu_bottles_sold") + F.col("month")
    rows.select(prediction.alias("prediction"), F.floor(spec.TARGET).alias("label")).write.parquet(stored)
    return training.error_metrics(spark.read.parquet(stored), label="label")


def _predicted(spark, sf_dir, **kw):
    dataset, model_dir, _ = trained(spark, sf_dir)
    return predict_plan.run_predict(spark, sales(spark, sf_dir), dataset, model_dir, O.WINDOW_START, O.WINDOW_END, **kw)


@register(
    "score_batch",
    O.WINDOW + "SELECT DISTINCT item_id AS item_number, DATE '2000-07-16' AS pred_date, true AS finite FROM padded WHERE last_valid_day <= 30",
)
def q_score_batch(spark, sf_dir):
    """Predict job on the window: saved scaler + saved model, one row per item."""
    return _predicted(spark, sf_dir).predictions.select("item_number", "pred_date", _finite().alias("finite"))


@register(
    "score_append",
    O.WINDOW
    + """
SELECT DISTINCT item_id AS item_number, DATE '2000-07-16' AS pred_date, CAST(2 AS BIGINT) AS n, true AS finite
FROM padded WHERE last_valid_day <= 30""",
)
def q_score_append(spark, sf_dir):
    """Append the window's predictions twice to a new table and read it back."""
    table = work_path(spark, "predictions")
    for _ in range(2):
        _predicted(spark, sf_dir, out_path=table)
    stored = spark.read.schema(scoring.PREDICTION_SCHEMA).parquet(table)
    return stored.groupBy("item_number", "pred_date").agg(F.count("*").alias("n"), F.bool_and(_finite()).alias("finite"))


def _finite():
    return ~F.isnan("pred_total_packs") & (F.abs("pred_total_packs") < float("inf"))


@register(
    "score_python",
    O.FULL
    + """
SELECT item_id, year, month, DATE '2000-07-16' AS pred_date, last_valid_day > 30 AS failed,
       CASE WHEN last_valid_day > 30 THEN NULL ELSE CAST(month + cumu_bottles_sold + 2 * daily_bottles_sold + 1 AS DOUBLE) END AS prediction
FROM padded WHERE day = least(last_valid_day, 30)""",
)
def q_score_python(spark, sf_dir):
    """A Python sequence model through predict_batch_udf, with whole-number weights."""
    weights = {"month": 1.0, "cumu_bottles_sold": 1.0, "daily_bottles_sold": 2.0}
    model = scoring.linear_step_model([weights.get(c, 0.0) for c in layout.STEP_FEATURES], 1.0)
    scored = scoring.score_sequences(prepared(spark, sf_dir), model, _PRED_DATE)
    return scored.select(*KEYS, "pred_date", F.col("error_class").isNotNull().alias("failed"), F.col("pred_total_packs").cast("double").alias("prediction"))


#: Items of the failing model below: it raises on one, answers NaN for the other.
_RAISES, _NOT_A_NUMBER = 7, 11
_FAILING_MODEL_CLASS = f"""CASE WHEN last_valid_day > 30 THEN 'other_errors' WHEN item_id % {_RAISES} = 0 THEN 'KeyErrors'
       WHEN item_id % {_NOT_A_NUMBER} = 0 THEN 'ValueErrors' END"""


def failing_model(weights: list[float], intercept: float):
    """A sequence model that refuses a whole batch for one item that it doesn't know, and has no number for others."""
    make, item = scoring.linear_step_model(weights, intercept), layout.STEP_FEATURES.index("item_id")

    def make_predict_fn():
        predict = make()

        def run(x):
            ids = x.reshape(len(x), spec.SEQ_LEN, -1)[:, 0, item].astype("int64")
            if (ids % _RAISES == 0).any():
                raise KeyError("unknown item")
            out = predict(x)
            out[ids % _NOT_A_NUMBER == 0] = float("nan")
            return out

        return run

    return make_predict_fn


def _scored_with_failures(spark, sf_dir):
    weights = {"month": 1.0, "cumu_bottles_sold": 1.0, "daily_bottles_sold": 2.0}
    model = failing_model([weights.get(c, 0.0) for c in layout.STEP_FEATURES], 1.0)
    return scoring.score_sequences(prepared(spark, sf_dir), model, _PRED_DATE)


@register(
    "score_isolated",
    O.FULL
    + f"""
SELECT item_id, year, month, {_FAILING_MODEL_CLASS} AS error_class,
       CASE WHEN {_FAILING_MODEL_CLASS} IS NULL THEN CAST(month + cumu_bottles_sold + 2 * daily_bottles_sold + 1 AS DOUBLE) END AS prediction
FROM padded WHERE day = least(last_valid_day, 30)""",
)
def q_score_isolated(spark, sf_dir):
    """A Python model that raises on batches with certain items loses exactly the rows of these."""
    return _scored_with_failures(spark, sf_dir).select(*KEYS, "error_class", F.col("pred_total_packs").cast("double").alias("prediction"))


@register(
    "score_model_errors",
    O.FULL
    + f"""
SELECT 'score' AS stage, CAST(count(*) AS BIGINT) AS n_elements, CAST(count(cls) AS BIGINT) AS failed_elements,
       CAST(0 AS BIGINT) AS AssertionErrors, CAST(count(*) FILTER (WHERE cls = 'KeyErrors') AS BIGINT) AS KeyErrors, CAST(0 AS BIGINT) AS TypeErrors,
       CAST(count(*) FILTER (WHERE cls = 'ValueErrors') AS BIGINT) AS ValueErrors,
       CAST(count(*) FILTER (WHERE cls = 'other_errors') AS BIGINT) AS other_errors
FROM (SELECT DISTINCT item_id, year, month, {_FAILING_MODEL_CLASS} AS cls FROM padded)""",
)
def q_score_model_errors(spark, sf_dir):
    """PRD-4: counters of a model's exceptions and answers that are no finite number."""
    return quality.error_counts(_scored_with_failures(spark, sf_dir), "score")


@register(
    "score_one_folder",
    O.WINDOW + "SELECT DISTINCT item_id AS item_number, DATE '2000-07-16' AS pred_date, true AS same FROM padded WHERE last_valid_day <= 30",
)
def q_score_one_folder(spark, sf_dir):
    """SCL-4: the saved model with its scaler on raw prepared rows, against scaler and model loaded apart."""
    _, model_dir, _ = trained(spark, sf_dir)
    whole = predict_plan.run_predict(spark, sales(spark, sf_dir), None, model_dir, O.WINDOW_START, O.WINDOW_END).predictions
    apart = _predicted(spark, sf_dir).predictions.withColumnRenamed("pred_total_packs", "other")
    return whole.join(apart, ["item_number", "pred_date"], "full").select(
        "item_number", "pred_date", F.col("pred_total_packs").eqNullSafe(F.col("other")).alias("same")
    )


_GOOD_LINES = f"SELECT c.*, k FROM coded c CROSS JOIN {O.TWICE} WHERE c.r NOT IN ({_FAILING}) AND (k = 1 OR c.r = {faults.LIST_LINE})"


@register(
    "conservation",
    _CODED
    + f"""
, counted AS (
  SELECT count(*) FILTER (WHERE k = 1) AS lines, count(*) FILTER (WHERE k = 1 AND r = 0) AS unread,
         count(*) FILTER (WHERE r <> 0 AND (k = 1 OR r = {faults.LIST_LINE})) AS elements,
         count(*) FILTER (WHERE k = 1 AND r IN ({_PREPARE_FAILING})) AS unprepared
  FROM coded CROSS JOIN {O.TWICE}),
late AS (SELECT count(*) FILTER (WHERE r = {faults.NO_YEAR}) AS unrouted, count(*) FILTER (WHERE dayofmonth(last_date) = 31) AS unscored FROM ({_GOOD_LINES})),
stages AS (
  SELECT 'train' AS job, 'parse' AS stage, lines AS n_in, unread AS n_failed FROM counted
  UNION ALL SELECT 'train', 'prepare', elements, unprepared FROM counted
  UNION ALL SELECT 'train', 'validate', elements - unprepared, 0 FROM counted
  UNION ALL SELECT 'train', 'split', elements - unprepared, unrouted FROM counted, late
  UNION ALL SELECT 'train', 'export', elements - unprepared - unrouted, 0 FROM counted, late
  UNION ALL SELECT 'predict', 'parse', lines, unread FROM counted
  UNION ALL SELECT 'predict', 'prepare', elements, unprepared FROM counted
  UNION ALL SELECT 'predict', 'validate', elements - unprepared, 0 FROM counted
  UNION ALL SELECT 'predict', 'score', elements - unprepared, unscored FROM counted, late
  UNION ALL SELECT 'predict', 'predictions', elements - unprepared - unscored, 0 FROM counted, late)
SELECT job, stage, CAST(n_in AS BIGINT) AS n_in, CAST(n_failed AS BIGINT) AS n_failed, CAST(n_failed AS BIGINT) AS n_quarantined FROM stages""",
)
def q_conservation(spark, sf_dir):
    """Train and predict jobs on lines with faults: what each stage got, what failed there by the
    counters, and what lies in quarantine by the tables; the rest is exported or predicted."""
    lines = read_lines(spark, ndjson_path(spark, sf_dir))
    dataset = work_path(spark, "conserved")
    trained_ = run_train(spark, lines, dataset, O.SPLIT_DATE, fmt="parquet")
    _, model_dir, _ = trained(spark, sf_dir)
    predicted = predict_plan.run_predict(spark, lines, trained_.fitted, model_dir, O.WINDOW_START, O.WINDOW_END)

    def job(name: str, counts: list[dict], quarantine: DataFrame, last: str, rows: DataFrame) -> DataFrame:
        told = spark.createDataFrame(
            [(name, c["stage"], c["n_elements"], c["failed_elements"]) for c in counts], "job string, stage string, n_in long, n_failed long"
        )
        kept = quarantine.groupBy("stage").agg(F.count("*").alias("n_quarantined"))
        told = told.join(kept, "stage", "left").select("job", "stage", "n_in", "n_failed", F.coalesce("n_quarantined", F.lit(0)).cast("long").alias("n_quarantined"))
        zero = F.lit(0).cast("long")
        end = rows.agg(F.count("*").alias("n_in")).select(F.lit(name).alias("job"), F.lit(last).alias("stage"), "n_in", zero.alias("n_failed"), zero.alias("n_quarantined"))
        return told.unionByName(end)

    exported = spark.read.parquet(f"{dataset}/examples")
    return job("train", trained_.counts, spark.read.parquet(f"{dataset}/_quarantine"), "export", exported).unionByName(
        job("predict", predicted.counts, predicted.quarantine, "predictions", predicted.predictions)
    )


_PRED_DATE = "2000-07-16"


@register(
    "pick_prediction",
    O.WINDOW
    + f"""
SELECT item_id, year, month, DATE '{_PRED_DATE}' AS pred_date, last_valid_day AS step,
       cumu_bottles_sold, daily_bottles_sold
FROM padded WHERE day = last_valid_day""",
)
def q_pick_prediction(spark, sf_dir):
    """The scored step: the day after the last sale, inputs of that step only."""
    inputs = scoring.step_inputs(window_prepared(spark, sf_dir), _PRED_DATE)
    return quality.good(inputs, ["item_id", "year", "month", "pred_date", "step", "cumu_bottles_sold", "daily_bottles_sold"])


@register(
    "score_errors",
    O.FULL
    + """
SELECT 'score' AS stage, CAST(count(*) AS BIGINT) AS n_elements,
       CAST(count(*) FILTER (WHERE last_valid_day > 30) AS BIGINT) AS failed_elements,
       CAST(0 AS BIGINT) AS AssertionErrors, CAST(0 AS BIGINT) AS KeyErrors, CAST(0 AS BIGINT) AS TypeErrors,
       CAST(0 AS BIGINT) AS ValueErrors,
       CAST(count(*) FILTER (WHERE last_valid_day > 30) AS BIGINT) AS other_errors
FROM (SELECT DISTINCT item_id, year, month, last_valid_day FROM padded)""",
)
def q_score_errors(spark, sf_dir):
    """PRD-4 counters over the whole table: a month that sold on day 31 has no next step."""
    return quality.error_counts(scoring.step_inputs(prepared(spark, sf_dir), _PRED_DATE), "score")


@register("padded_sequences_window", O.FULL + f"SELECT {O.PADDED_COLS} FROM padded")
def q_padded_sequences_window(spark, sf_dir):
    """Window (long) form of the padding, same result as the array form."""
    return padded_long_window(raw_samples(sales(spark, sf_dir)))


@register("events_sequences", O.EVENTS + f"SELECT {O.PADDED_COLS} FROM padded")
def q_events_sequences(spark, sf_dir):
    """Second input shape: the events table, one user = one item (thin sequences)."""
    ship_package(spark)
    return explode_days(good_rows(prepare_samples(raw_samples(events_sales(spark, sf_dir)))))


from daybook.plans import registry_jobs  # noqa: E402, F401 - registers the queries of the jobs that go on where they ended
