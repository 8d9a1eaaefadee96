"""Incremental upkeep of a stored point-in-time table.

The table is partitioned by snapshot day.  Its newest commit says which days it
covers and which state of the spine and of the history it shows.  A refresh
compares that state with the present one, finds the days whose snapshot
differs (new and late events, corrections, new keys), and writes these and the
days that are new to the window; the files of all other days stay.  The first
run, and one whose earlier state is no longer kept, writes all days.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.operators.asof import changed_days, pit
from vaultline.sources.stored import StoredTable

DAY = "snapshot_date"


def days_between(start: _dt.date, end: _dt.date) -> list[_dt.date]:
    return [start + _dt.timedelta(days=i) for i in range((end - start).days + 1)]


def _dealt(rows: DataFrame, key: str, n_days: int) -> DataFrame:
    """One hash shuffle by (day, slice of the keys) before a write partitioned
    by day: as many slices as give every shuffle task something to write, so
    a day is written by a few tasks, as a few files."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(1, tasks // max(n_days, 1))
    return rows.repartition(F.col(DAY), F.pmod(F.xxhash64(key), F.lit(slices)))


def refresh_pit(
    table: StoredTable,
    parents: DataFrame,
    history: DataFrame,
    key: str,
    ts: str,
    value: str,
    start: _dt.date,
    end: _dt.date,
    before: tuple[DataFrame, DataFrame] | None,
    state: dict | None = None,
    tie: Sequence[str | Column] = (),
    value_name: str | None = None,
    ts_name: str | None = None,
    bucket: Callable[[], Column] | None = None,
) -> list[_dt.date] | None:
    """Bring ``table`` to the snapshots of ``[start, end]``; returns the days
    written, or None where all were.

    ``before`` is the (parents, history) that the table's newest commit shows,
    None if it can't be read any more.  ``state`` is noted in the commit, for the
    caller to find that state again."""
    args = dict(key=key, ts=ts, values=[value], tie=list(tie), value_names=[value_name or value],
                ts_name=ts_name or ts, bucket=bucket() if bucket else None)
    meta = {**(state or {}), "start": str(start), "end": str(end)}
    now = table.commit()
    if now is None or before is None or not now["meta"].get("end"):
        rows = pit(parents, history, start=start, end=end, **args)
        table.replace(_dealt(rows, key, (end - start).days + 1), [DAY], meta)
        return None
    old_start, old_end = (_dt.date.fromisoformat(now["meta"][k]) for k in ("start", "end"))
    covered = set(days_between(old_start, old_end))
    wanted = set(days_between(start, end))
    both = sorted(covered & wanted)
    touched = set()
    if both:
        found = changed_days(before, (parents, history), key, ts, value, both[0], both[-1], tie=list(tie),
                             bucket=bucket() if bucket else None)
        touched = {r[0] for r in found.collect()}  # at most one row per day of the window
    days = sorted(touched | (wanted - covered))
    if days or covered - wanted:
        rows = pit(parents, history, start=start, end=end, days=days, **args)
        table.replace_partitions(_dealt(rows, key, len(days)), [*days, *(covered - wanted)], meta)
    return days
