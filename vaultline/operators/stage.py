"""Staging: typed columns + hash keys + change hashes + load metadata.

A staging table is one projection over a feed.  It is expressed as two
``select`` steps (typed columns and hub keys first, then link keys and
hashdiffs that refer to them) which Catalyst collapses into the scan's
projection; nothing here shuffles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.functions.keys import hashdiff


def stage(
    df: DataFrame,
    columns: Sequence[Column | str],
    keys: Mapping[str, Column] | None = None,
    derived_keys: Mapping[str, Column] | None = None,
    diffs: Mapping[str, Sequence[Column | str | None]] | None = None,
    record_source: str = "unknown",
    load_date: Column | None = None,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Build a staging DataFrame.

    ``columns``      typed output columns (expressions over the feed)
    ``keys``         hub keys over feed columns (aliased by their name)
    ``derived_keys`` link keys etc. over the typed columns and ``keys``
    ``diffs``        hashdiff name -> attribute list (``None`` = absent in feed)
    ``load_date``    batch timestamp; fixed per batch so reruns are comparable
    """
    first = df.select(
        *columns, *[expr.alias(name) for name, expr in (keys or {}).items()]
    )
    load = load_date if load_date is not None else F.current_timestamp()
    return first.select(
        *first.columns,
        *[expr.alias(name) for name, expr in (derived_keys or {}).items()],
        *[hashdiff(attrs).alias(name) for name, attrs in (diffs or {}).items()],
        *extra,
        load.alias("load_date"),
        F.lit(record_source).alias("record_source"),
    )
