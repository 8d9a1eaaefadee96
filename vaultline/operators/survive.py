"""Survivorship: pick one golden row per key across sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def source_rank(source_col: str, preferred: Sequence[str]) -> Column:
    """0 for the first preferred source, 1 for the next, ...; others last."""
    expr = F.lit(len(preferred))
    for i, s in reversed(list(enumerate(preferred))):
        expr = F.when(F.col(source_col) == s, F.lit(i)).otherwise(expr)
    return expr


def survive(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """First row per ``key`` by ``order``.

    ``row_number() = 1`` is planned as a partial ``WindowGroupLimit`` before
    the shuffle and a final one after it, so every key -- hot or not -- is cut
    to one row per map task before any data moves.
    """
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
