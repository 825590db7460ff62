"""Row counts and slices by day or month."""

from __future__ import annotations

import functools
from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_bounds(year: int, month: int | None = None) -> tuple[date, date]:
    """First day of the month (or year) and first day after it."""
    if month is None:
        return date(year, 1, 1), date(year + 1, 1, 1)
    return date(year, month, 1), date(year + month // 12, month % 12 + 1, 1)


def time_slice(df: DataFrame, column: str, start: date, stop: date) -> DataFrame:
    """Rows with ``start <= column < stop``.

    A half-open range on the bare column reaches the Parquet scan as a pushed
    filter, which year() and month() of it would not.
    """
    return df.where(time_range(df, column, start, stop))


def time_range(df: DataFrame, column: str, start: date, stop: date) -> Column:
    kind = df.schema[column].dataType.simpleString()
    return (F.col(column) >= F.lit(start).cast(kind)) & (F.col(column) < F.lit(stop).cast(kind))


def month_slices(df: DataFrame, column: str, months: Iterable[tuple[int, int]]) -> DataFrame:
    """Rows of some months (year, month), from one scan, with the month as a column."""
    slices = [time_range(df, column, *month_bounds(*month)) for month in months]
    wanted = functools.reduce(Column.__or__, slices, F.lit(False))
    return df.where(wanted).withColumn("month", F.trunc(column, "month"))


def rows_per_day(df: DataFrame, day: str = "created_date") -> DataFrame:
    return df.groupBy(day).agg(F.count(F.lit(1)).alias("rows_loaded"))


def rows_per_month(df: DataFrame, day: str = "created_date") -> DataFrame:
    return df.groupBy(F.trunc(day, "month").alias("month")).agg(
        F.count(F.lit(1)).alias("rows_loaded")
    )


def days_without_rows(df: DataFrame, day: str, until: str) -> DataFrame:
    """Calendar days from the first ``day`` to the last ``until`` that no row falls on.

    One scan: rows are reduced to their days, and everything else is done with those,
    a list of calendar days.
    """
    days = df.groupBy(day).agg(F.max(until).alias("last"))
    bounds = days.agg(
        F.min(day).alias("first"), F.max("last").alias("last"), F.collect_set(day).alias("there")
    )
    calendar = F.sequence("first", "last", F.expr("interval 1 day"))
    return bounds.select(F.explode(F.array_except(calendar, "there")).alias(day))
