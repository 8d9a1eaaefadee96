"""Calendar (date dimension) generated with ``sequence`` + ``explode``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.functions.dates import date_key


def calendar_columns(day: Column) -> list[Column]:
    dow = F.dayofweek(day)
    return [
        date_key(day).alias("date_key"),
        day.alias("date_day"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        dow.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        dow.isin(1, 7).alias("is_weekend"),
    ]


def calendar(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row per day between the ``start`` and ``end`` date columns.

    ``bounds`` is normally a one-row aggregate (e.g. min/max of a fact's
    dates); days are generated with ``explode(sequence(...))``.
    """
    days = bounds.select(
        F.explode(F.sequence(F.col(start).cast("date"), F.col(end).cast("date"))).alias("d")
    )
    return days.select(*calendar_columns(F.col("d")))


def calendar_window(
    anchor: DataFrame, day_col: str, days_back: int = 730, days_ahead: int = 365
) -> DataFrame:
    """Calendar from ``day - days_back`` to ``day + days_ahead`` for an anchor day."""
    b = anchor.select(
        F.date_sub(F.col(day_col).cast("date"), days_back).alias("start"),
        F.date_add(F.col(day_col).cast("date"), days_ahead).alias("end"),
    )
    return calendar(b)
