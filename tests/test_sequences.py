"""Golden samples, the pandas oracle on random sequences, array form = window form."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook import spec
from daybook.operators.rollup import raw_samples
from daybook.functions.parsing import TableFields
from daybook.operators.sequences import _running_total, explode_days, good_rows, padded_long_window, prepare_samples
from daybook.sources.sales import lineitem_sales

from conftest import SF_SMALL


def _prepare_json(spark, docs):
    lines = spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")
    return prepare_samples(lines.select(F.parse_json("value").alias("v")))


def test_golden_partial_month(spark, samples):
    row = _prepare_json(spark, [samples[1]]).collect()[0]
    assert row.error_class is None
    assert (row.item_id, row.year, row.month, row.last_valid_day) == (68039, 2020, 6, 15)
    assert row.total_packs_sold == [17.75] * 31
    assert sum(row.valid_day) == 9
    assert row.daily_bottles_sold[:16] == [5, 2, 10, 10, 10, 8, 4, 8, 16, 16, 16, 16, 6, 6, 12, 12]
    assert row.daily_bottles_sold[16:] == [12] * 15
    assert row.cumu_bottles_sold[:16] == [5, 7, 17, 17, 17, 25, 29, 37, 53, 53, 53, 53, 59, 59, 71, 71]
    assert row.cumu_bottles_sold[16:] == [71] * 15
    assert row.day == list(range(31))


def test_golden_full_month(spark, samples):
    row = _prepare_json(spark, [samples[0]]).collect()[0]
    assert row.error_class is None
    assert (row.month, row.last_valid_day) == (0, 31)
    assert row.daily_bottles_sold[:2] == [570, 570] and row.cumu_bottles_sold[:2] == [570, 570]
    assert sum(row.valid_day) == 17
    assert row.cumu_bottles_sold[-1] == 11751
    assert row.total_packs_sold[0] == 489.625


def test_schema_matches_spec(spark):
    prepared = good_rows(prepare_samples(raw_samples(lineitem_sales(spark, SF_SMALL))))
    assert prepared.columns == spec.FEATURE_NAMES
    types = {f.name: f.dataType.simpleString() for f in prepared.schema.fields}
    assert types["item_id"] == "bigint" and types["day"] == "array<bigint>"
    assert types["cumu_bottles_sold"] == "array<double>" and types["item_description"] == "string"


def _by_hand(dates, quantities, pack_size):
    """The 31 days from their definition: a sale's values hold until the next sale day; the first one's also before it."""
    sales, so_far = {}, 0
    for date, quantity in zip(dates, quantities):
        so_far += int(quantity)
        sales[int(date[-2:])] = (float(quantity), float(so_far))
    held = sales[min(sales)]
    daily, running = [], []
    for day in range(1, 32):
        held = sales.get(day, held)
        daily.append(held[0])
        running.append(held[1])
    real = [int(day in sales) for day in range(1, 32)]
    return int(dates[-1][-2:]), daily, running, real, so_far / pack_size


def test_random_sequences_by_hand(spark):
    rng = np.random.default_rng(7)
    docs = []
    for i in range(300):
        n = int(rng.integers(1, 32))
        days = rng.choice(np.arange(1, 32), size=n, replace=False)
        if rng.random() < 0.7:
            days = np.sort(days)  # 30 % stay unsorted: running total follows array order
        dates = [f"2021-03-{d:02d}" for d in days]
        qty = [str(int(x)) for x in rng.integers(0, 50, size=n)]
        docs.append({"item_number": str(i), "item_description": "d", "cost": 1.0, "retail": 2.0,
                     "volume_ml": 750, "pack_size": int(rng.integers(1, 13)), "year_month": "2021-03",
                     "dates_arr": dates, "daily_bottles_sold_arr": qty})
    rows = {r.item_id: r for r in _prepare_json(spark, docs).collect()}
    for i, d in enumerate(docs):
        r = rows[i]
        assert r.error_class is None
        last, q, cumu, valid, target = _by_hand(d["dates_arr"], d["daily_bottles_sold_arr"], d["pack_size"])
        assert r.last_valid_day == last
        assert r.daily_bottles_sold == q
        assert r.cumu_bottles_sold == cumu
        assert r.valid_day == valid
        assert r.total_packs_sold == [target] * 31
        assert sum(r.valid_day) == len(d["dates_arr"])


def test_array_form_equals_window_form(spark):
    raw = raw_samples(lineitem_sales(spark, SF_SMALL))
    a = explode_days(good_rows(prepare_samples(raw)))
    w = padded_long_window(raw).select(*a.columns)
    assert a.count() == w.count() == a.select("item_id", "year", "month").distinct().count() * 31
    assert a.exceptAll(w).count() == 0 and w.exceptAll(a).count() == 0


def test_zero_pack_size_gives_infinite_target(spark, samples):
    doc = dict(samples[1], pack_size=0)
    row = _prepare_json(spark, [doc]).collect()[0]
    assert row.error_class is None and row.total_packs_sold[0] == float("inf")


def test_long_lists_take_linear_time_and_sum_right(spark, samples):
    import time

    def took(n):
        doc = dict(samples[0], dates_arr=["2012-01-03"] * n, daily_bottles_sold_arr=["1"] * n)
        start = time.time()
        row = _prepare_json(spark, [doc]).collect()[0]
        assert row.error_class == "ValueErrors"  # a day twice; the sums were made before that
        return time.time() - start

    took(100)
    took(16000)
    assert took(16000) < 8
    rows = spark.range(1).select(_running_total(F.sequence(F.lit(1).cast("bigint"), F.lit(1000).cast("bigint"))).alias("t"), _running_total(F.array().cast("array<bigint>")).alias("e"))
    row = rows.first()
    assert row.t == [i * (i + 1) // 2 for i in range(1, 1001)] and row.e == []


def test_sum_beyond_64_bits_is_an_error(spark, samples):
    doc = dict(samples[1], dates_arr=["2020-07-01", "2020-07-02"], daily_bottles_sold_arr=["9223372036854775807", "1"])
    row = _prepare_json(spark, [doc]).collect()[0]
    assert row.error_class == "other_errors" and "64 bits" in row.error_message


@pytest.mark.parametrize("text,value", [("1.5", 1.5), (" 2e1 ", 20.0), ("+.5", 0.5), ("1.", 1.0), ("inf", float("inf")), ("1.5f", None), ("1.5d", None), ("0x1p3", None), ("", None)])
def test_numbers_as_text(spark, samples, text, value):
    row = _prepare_json(spark, [dict(samples[0], cost=text)]).collect()[0]
    assert (row.cost if row.error_class is None else None) == value
    typed = spark.createDataFrame([(text,)], "cost string")
    assert typed.select(TableFields(typed.schema).double_value("cost")).first()[0] == value


def test_one_number_as_quantities(spark, samples):
    row = _prepare_json(spark, [dict(samples[0], daily_bottles_sold_arr=5)]).collect()[0]
    assert (row.error_class, row.error_message) == ("TypeErrors", "quantities are not a list")


def test_steps_are_worked_out_once(spark):
    """no filter or list repeats a sample's running total or runs of days; F13: the lines are dealt once."""
    raw = raw_samples(lineitem_sales(spark, SF_SMALL))
    plan = explode_days(good_rows(prepare_samples(raw)))._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not [f for f in filters if "aggregate(" in f or "sequence(" in f]
    assert raw._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
