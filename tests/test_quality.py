"""One bad input per error class (FIXTURES F4), counters, validator, UDF-1."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators import quality
from daybook.operators.mapping import error_class_of, input_count, map_and_quarantine, results
from daybook.operators.sequences import good_rows, prepare_samples
from daybook.sources.ndjson import mark_lines, parse_lines


def _classes(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    elements, marked = parse_lines(df)
    parse_bad = [r.error_class for r in marked.where("error_class is not null").collect()]
    prepared = prepare_samples(elements, keep=["line"]).orderBy("line")
    return parse_bad, [(r.error_class, r.error_message) for r in prepared.collect()]


def _variant(b, **change):
    d = dict(b)
    for k, v in change.items():
        if v is KeyError:
            d.pop(k)
        else:
            d[k] = v
    return json.dumps(d)


CASES = [
    ("cost", KeyError, "KeyErrors"),
    ("year_month", None, "other_errors"),
    ("year_month", "2020", "ValueErrors"),
    ("year_month", "2020-07-01", "ValueErrors"),
    ("item_number", "x68039", "ValueErrors"),
    ("item_number", "12.0", "ValueErrors"),
    ("item_number", None, "TypeErrors"),
    ("pack_size", None, "TypeErrors"),
    ("pack_size", "abc", "ValueErrors"),
    ("item_description", None, "AssertionErrors"),
    ("item_description", 5, "AssertionErrors"),
]


@pytest.mark.parametrize("key,value,expected", CASES)
def test_single_fault(spark, samples, key, value, expected):
    _, got = _classes(spark, [_variant(samples[1], **{key: value})])
    assert got[0][0] == expected, got


def test_array_faults(spark, samples):
    b = samples[1]
    lines = [
        _variant(b, daily_bottles_sold_arr=["5.7"] + b["daily_bottles_sold_arr"][1:]),
        _variant(b, dates_arr=["2020-02-30"] + b["dates_arr"][1:]),
        _variant(b, dates_arr=b["dates_arr"][:-1]),
        _variant(b, dates_arr=[], daily_bottles_sold_arr=[]),
        _variant(b, dates_arr=b["dates_arr"] + [b["dates_arr"][0]], daily_bottles_sold_arr=b["daily_bottles_sold_arr"] + ["1"]),
        _variant(b, daily_bottles_sold_arr=[None] + b["daily_bottles_sold_arr"][1:]),
    ]
    _, got = _classes(spark, lines)
    assert sorted(c for c, _ in got) == sorted(
        ["ValueErrors", "ValueErrors", "ValueErrors", "other_errors", "ValueErrors", "TypeErrors"]
    )


def test_parse_stage_and_lists(spark, samples):
    a, b = samples
    lines = [json.dumps(b)[:40], json.dumps([a, b]), "[]", "null", "5", '"x"']
    parse_bad, got = _classes(spark, lines)
    assert parse_bad == ["ValueErrors"]
    classes = sorted(str(c) for c, _ in got)
    # list -> 2 good rows; [] -> nothing; null / 5 / "x" -> TypeErrors
    assert classes == sorted(["None", "None", "TypeErrors", "TypeErrors", "TypeErrors"])


def test_error_counts_and_observation(spark, samples):
    a, b = samples
    df = spark.createDataFrame([(json.dumps(a),), (json.dumps(dict(b, pack_size=None)),)], "value string")
    elements, _ = parse_lines(df)
    prepared = prepare_samples(elements)
    row = quality.error_counts(prepared, "prepare").collect()[0]
    assert (row.n_elements, row.failed_elements, row.TypeErrors) == (2, 1, 1)
    observed, obs = quality.observe_errors(prepared, "prepare")
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get["failed_elements"] == 1


def test_validator(spark, samples):
    from daybook.operators.sequences import good_rows

    df = spark.createDataFrame([(json.dumps(samples[1]),)], "value string")
    elements, _ = parse_lines(df)
    good = good_rows(prepare_samples(elements))
    broken = good.withColumn("valid_day", F.slice("valid_day", 1, 30))
    row = quality.validate_examples(broken).collect()[0]
    assert row.error_class == "AssertionErrors"
    assert row.error_message == "68039_2020_6: valid_day shape (30,) but should be (31,)"
    assert quality.validate_examples(good).collect()[0].error_class is None
    with pytest.raises(AssertionError):
        quality.check_schema(good.withColumn("cost", F.lit("x")))


def test_map_and_quarantine_classes(spark):
    def fn(x):
        if x == "a":
            raise AssertionError("a")
        if x == "k":
            return {}["missing"]
        if x == "t":
            return None + 1
        if x == "v":
            return int("v")
        if x == "o":
            return [][1]
        if x == "many":
            return [{"out": "m1"}, {"out": "m2"}]
        return {"out": x}

    df = spark.createDataFrame([(x,) for x in ["a", "k", "t", "v", "o", "ok", "many"]], "value string")
    out = map_and_quarantine(df, fn, T.StructType([T.StructField("out", T.StringType())]), ["value"])
    rows = sorted((r.out or "", r.error_class or "") for r in out.collect())
    assert rows == sorted(
        [("", "AssertionErrors"), ("", "KeyErrors"), ("", "TypeErrors"), ("", "ValueErrors"), ("", "other_errors"),
         ("ok", ""), ("m1", ""), ("m2", "")]
    )
    assert error_class_of(json.JSONDecodeError("x", "y", 0)) == "ValueErrors"


def test_results_beside_failures_keep_their_values(spark):
    import datetime as dt

    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("d", T.DateType()), T.StructField("a", T.ArrayType(T.LongType()))])
    big = 9007199254740993

    def fn(x):
        if x == "bad":
            raise ValueError("bad")
        if x == "none":
            return []
        if x == "wrong":
            return {"n": "text"}
        return [{"n": big, "d": dt.date(2020, 1, 2), "a": [big, None]}] * 3

    df = spark.createDataFrame([(x,) for x in ["bad", "none", "many", "wrong"]], "value string").coalesce(1)
    out = map_and_quarantine(df, fn, schema, ["value"])
    assert [tuple(r) for r in results(out).collect()] == [(big, dt.date(2020, 1, 2), [big, None])] * 3
    counts = quality.error_counts(out, "map", input_count()).first()
    assert (counts.n_elements, counts.failed_elements, counts.ValueErrors, counts.TypeErrors) == (4, 2, 1, 1)


def test_lines_that_python_reads(spark):
    lines = ['{"a": NaN, "b": [1, -Infinity], "c": "NaN it is"}', '{"a": NaN, "c": "x, NaN]"}', '{"a": 1, "a": 2}', '{"a": nan}', "[1"]
    marked = mark_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    got = [(F_(r.doc), r.error_class) for r in marked.select(F.to_json("doc").alias("doc"), "error_class").collect()]
    assert got[0][1] is None and got[0][0]["a"] == "NaN" and got[0][0]["b"] == [1, "-Infinity"]
    assert got[2] == ({"a": 2}, None) and got[1][1] == got[3][1] == got[4][1] == "ValueErrors"


def F_(text):
    return json.loads(text) if text else None


def test_missing_elements_fail_the_validator(spark, samples):
    good = good_rows(prepare_samples(parse_lines(spark.createDataFrame([(json.dumps(samples[1]),)], "value string"))[0]))
    holed = good.withColumn("daily_bottles_sold", F.transform("daily_bottles_sold", lambda x, i: F.when(i != 3, x)))
    assert quality.validate_examples(holed).first().error_message == "68039_2020_6: daily_bottles_sold has a missing element"


def test_sales_values_that_do_not_fit(spark):
    from daybook.sources.sales import SALES_COLUMNS, mark_sales, sales_scan

    rows = [("1", "a", "1.5", "2", "750", "6", "2020-01-02", "3"), ("2", "b", "x", "2", "750", "6", "2020-13-01", "3"), ("3", None, None, "2", "750", "6", "2020-01-02", None)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in SALES_COLUMNS))
    assert sales_scan(df).where("date IS NULL").count() == 1
    marked = mark_sales(df).collect()
    assert [r.error_class for r in marked] == [None, "ValueErrors", None]
    assert marked[1].error_message == "state_bottle_cost is not a double" and json.loads(marked[1].raw)["date"] == "2020-13-01"
