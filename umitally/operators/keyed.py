"""Keyed-table operations: lookup, insertion, replacement, deletion, selection, order, scan and size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from umitally.sources.workdir import stored


def find(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of table whose key is among keys."""
    return table.join(keys.select(key).distinct(), key, "left_semi")


def add(table: DataFrame, rows: DataFrame) -> DataFrame:
    """table and the new rows. A key that is there already is not looked for; see replace()."""
    return table.unionByName(rows)


def add_in_order(table: DataFrame, rows: DataFrame, *by: str | Column) -> DataFrame:
    """add() with the rows in the given order."""
    return add(table, rows).orderBy(*by)


def count(table: DataFrame) -> DataFrame:
    """One row: n, the number of rows."""
    return table.agg(F.count(F.lit(1)).alias("n"))


def scan(table: DataFrame, inserted: str, action: Callable[[Iterator[Row]], None]) -> None:
    """Give action all rows in the order of `inserted`. The table is sorted by all executors; the driver then asks for one
    partition after another, and holds no more than the one that is being read."""
    action(table.orderBy(inserted).toLocalIterator())


def replace(table: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row a key: the last by order, as later rows replace earlier ones. Combined before the shuffle."""
    rest = [c for c in table.columns if c != key]
    last = F.max(F.struct(*order, *(c for c in rest if c not in order))).alias("_last")
    return table.groupBy(key).agg(last).select(*(F.col(c) if c == key else F.col(f"_last.{c}").alias(c) for c in table.columns))


def upsert(table: DataFrame, rows: DataFrame, key: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(the table with rows put in, the rows of the table that were replaced); both have a row for each key at most.

    Of rows of one key the last by order is put in. One pass pairs a key's row of the table with the new one, combined before
    the shuffle; its outcome is kept, so that both results are read from it. Keys of the table are distinct, and null is a key.
    """
    columns = table.columns
    of = lambda df, side: df.select(key, F.struct(*order, *(c for c in columns if c not in order)).alias(side))
    both = of(table, "_old").withColumn("_new", F.lit(None).cast(of(table, "_old").schema["_old"].dataType)).unionByName(of(rows.select(*columns), "_new"), allowMissingColumns=True)
    paired = stored(both.groupBy(key).agg(F.max("_old").alias("_old"), F.max("_new").alias("_new")))
    now = F.coalesce("_new", "_old")
    return paired.select(*(now[c].alias(c) for c in columns)), paired.where("_old IS NOT NULL AND _new IS NOT NULL").select(*(F.col(f"_old.{c}").alias(c) for c in columns))


def delete(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of table whose key is not among keys."""
    return table.join(keys.select(key).distinct(), key, "left_anti")


def select(table: DataFrame, condition: Column) -> DataFrame:
    return table.where(condition)


def sort(table: DataFrame, *by: str | Column) -> DataFrame:
    return table.orderBy(*by)
