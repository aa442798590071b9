"""Sales loaded in slices: the same samples as at once, repeated loads add nothing."""

import os

import pytest
from pyspark.sql import functions as F

from daybook.operators.rollup import raw_samples
from daybook.plans import incremental
from daybook.sources.sales import lineitem_sales

from conftest import SF_SMALL


def rows(df):
    def norm(v):
        return round(v, 9) if isinstance(v, float) else v

    return sorted((tuple(norm(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def sales(spark):
    return lineitem_sales(spark, SF_SMALL).where("year(date) = 1997").cache()


def test_slices_equal_one_load_and_repeats_add_nothing(spark, sales, tmp_path):
    whole = rows(raw_samples(sales))
    part = lambda k: sales.where(F.pmod(F.xxhash64(*sales.columns), F.lit(3)) == k)
    base = str(tmp_path / "t")
    for k in (0, 1, 1, 2, 0):
        incremental.load_sales(part(k), base, f"slice-{k}")
    assert rows(incremental.samples(spark, base)) == whole
    incremental.load_sales(part(0).limit(0), base, "empty")
    assert rows(incremental.samples(spark, base)) == whole
    incremental.load_sales(part(2).where("month(date) = 3"), base, "more")
    doubled = rows(raw_samples(sales.unionByName(part(2).where("month(date) = 3"))))
    assert rows(incremental.samples(spark, base)) == doubled


def test_a_load_touches_only_its_months(spark, sales, tmp_path):
    base = str(tmp_path / "t")
    incremental.load_sales(sales.where("month(date) IN (1, 2)"), base, "a")
    stamp = lambda m: {f: os.stat(f"{base}/samples/year_month={m}/{f}").st_mtime_ns for f in os.listdir(f"{base}/samples/year_month={m}")}
    january = stamp("1997-01")
    assert incremental.load_sales(sales.where("month(date) = 2").limit(10), base, "b") == ["1997-02"]
    assert stamp("1997-01") == january
    assert incremental.samples(spark, base, ["1997-02"]).select("year_month").distinct().count() == 1


def test_lines_without_a_date_have_a_month_of_their_own(spark, sales, tmp_path):
    base = str(tmp_path / "t")
    odd = sales.limit(5).withColumn("date", F.lit(None).cast("date"))
    assert None in incremental.load_sales(sales.where("month(date) = 5").unionByName(odd), base, "a")
    assert rows(incremental.samples(spark, base)) == rows(raw_samples(sales.where("month(date) = 5").unionByName(odd)))
