"""Date helpers for the star schema, all Spark built-ins."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c: str | Column) -> Column:
    """yyyyMMdd as int (NULL stays NULL)."""
    return F.date_format(_col(c), "yyyyMMdd").cast("int")


def midnight(day: str | _dt.date) -> Column:
    """A day as a TIMESTAMP_NTZ literal at 00:00.

    The driver's parquet timestamps read as ``timestamp_ntz``; comparing with
    an NTZ literal keeps the predicate a plain column-vs-literal filter that
    parquet can push down.
    """
    return F.lit(str(day)).cast("date").cast("timestamp_ntz")


def ntz(ts: str) -> Column:
    """A TIMESTAMP_NTZ literal from 'yyyy-MM-dd HH:mm:ss'."""
    return F.lit(ts).cast("timestamp_ntz")


def is_midnight(c: str | Column) -> Column:
    """True at 00:00:00 exactly (zone-free: date -> timestamp_ntz is wall clock)."""
    return _col(c) == F.to_date(_col(c)).cast("timestamp_ntz")
