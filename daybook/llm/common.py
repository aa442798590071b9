"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import ensure_checkpoint_dir, ship_package, work_path

#: White space of the word definition `[^\x20\x09-\x0D]+`.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


def col(name: str) -> Column:
    """A top-level column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only, as ``translate`` does in SQL."""
    return F.translate(c, UPPER, LOWER)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, although ``use`` names it several times."""
    return F.transform(F.array(value), use)[0]


def carried(df: DataFrame, **named: str) -> DataFrame:
    """All columns of ``df`` as one struct ``row``, beside those that a step reads under the names it uses.

    ``select("row.*")`` gives the input's columns back, whatever their names.
    """
    return df.select(F.struct(*[col(c) for c in df.columns]).alias("row"), *[col(c).alias(n) for n, c in named.items()])


def words(text: Column) -> Column:
    """Maximal runs without blanks, in order; a null or blank text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    Cuts the lineage so that a lost executor re-reads a file instead of
    repeating the work, and so that several later passes share one result.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes in this block go as each write ends: who reads the written table needs none of them."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def prepared_session(spark: SparkSession) -> SparkSession:
    """Checkpoint folder known and the package importable in Python workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
