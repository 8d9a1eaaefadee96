"""Insert-only hub, link and satellite loaders.

All loaders are *pure*: given the new staging rows and (optionally) the rows
already stored in the target, they return exactly the rows to append.
Writing is a separate step (``vaultline.sources.sinks.append``), so the same
code runs in tests without disk and in production against parquet tables.

``keys_checked=True`` tells a loader that its feed already excludes NULL keys
(e.g. by filtering the raw id columns, which reaches the parquet scan); the
loader then adds no ``key IS NOT NULL`` filter, which Catalyst would otherwise
push below the projection and evaluate on the hash expression a second time.

Plans (one shuffle per step, all keyed on the hash key):

* hub / link: drop NULL keys -> first row per key (``row_number() = 1``, which
  Spark plans as a partial ``WindowGroupLimit`` before the shuffle, i.e. a
  map-side top-1 per key) -> ``left_anti`` against the target's key column.
* satellite: take from the stored history only the rows a batch row can
  follow (per key: the latest stored rows before the batch's first timestamp,
  found by a partial aggregate over the stored timestamps, and every stored row
  from that timestamp on), union with the batch, and
  keep a row when its hashdiff differs from the previous row of the same
  ``(key, record_source)`` ordered by ``(ldts, tie, hashdiff, origin)``;
  stored rows sort before new rows with the same position, so re-running a
  batch appends nothing.

``distinct_keys=True`` tells the hub and link loaders that their single feed has
one row per key already (it is distinct on the raw ids that the key hashes one
to one), so no row has to be dealt out by the hash for a first-per-key.

``by`` tells the link loader that the link key follows from the hub keys: the first
row per combination of hub keys is kept, dealt out by that one hub key, so that
a join on it afterwards needs no other shuffle and the link key none at all.
``as_key`` gives the form in which a key is moved (packed, or an id of the feed that
it hashes one to one).

``within`` tells the link loader of a feed's id that follows from the link key: a feed
that is dealt out by it already is not dealt out again by the link key.

``ids`` tells the link loader that its feed and the stored frames hold the raw ids
that the link key hashes one to one: they are compared instead of keys, and the
caller derives the keys of the narrow rows it gets.  ``then`` lays out the rows that
are left.

``existing`` is the stored table or the list of frames it consists of (for
bucketed targets one per stored part, so that each join keeps the bucketing).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.functions.keys import pack_key
from vaultline.operators.sequence import previous_value


Stored = DataFrame | Sequence[DataFrame] | None


def _as_list(x):
    return list(x) if isinstance(x, (list, tuple)) else [x]


def _not_stored(rows: DataFrame, existing: Stored, pk: str | Sequence[str]) -> DataFrame:
    for part in _as_list(existing) if existing is not None else []:
        rows = rows.join(part.select(*_as_list(pk)), pk, "left_anti")
    return rows


def _first_per_key(
    frames: Sequence[DataFrame],
    pk: str,
    cols: Sequence[str],
    ldts: str,
    tie: Sequence[str],
    within: Sequence[str] = (),
) -> DataFrame:
    union = None
    for i, f in enumerate(frames):
        part = f.select(*within, *cols).withColumn("_src_order", F.lit(i))
        union = part if union is None else union.unionByName(part)
    w = Window.partitionBy(*within, pk).orderBy(
        F.col(ldts), F.col("_src_order"), *[F.col(c) for c in tie]
    )
    return (
        union.withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") == 1)
        .drop("_rn", "_src_order", *within)
    )


def hub_rows(
    new: DataFrame | Sequence[DataFrame],
    pk: str,
    nk: str | Sequence[str],
    ldts: str = "load_date",
    source: str = "record_source",
    existing: Stored = None,
    keys_checked: bool = False,
    distinct_keys: bool = False,
    by_natural_key: bool = False,
) -> DataFrame:
    """Rows to append to a hub: one per business key not yet in ``existing``.

    ``by_natural_key``: the hash key follows one to one from the natural key, so
    rows are dealt out by the latter, and without a hash key that nobody reads.

    ``new`` may be a list of staging frames (multi-source hub); on equal load
    timestamps the earlier frame in the list wins, then the smaller natural
    key, so the result is deterministic.
    """
    frames = _as_list(new)
    nks = _as_list(nk)
    cols = [pk, *nks, ldts, source]
    if not keys_checked:
        frames = [f.select(*cols).filter(F.col(pk).isNotNull()) for f in frames]
    if distinct_keys and len(frames) == 1:
        return _not_stored(frames[0].select(*cols), existing, pk)
    key = nks[0] if by_natural_key and len(nks) == 1 else pk
    return _not_stored(_first_per_key(frames, key, cols, ldts, tie=nks), existing, pk)


def link_rows(
    new: DataFrame | Sequence[DataFrame],
    pk: str,
    fks: Sequence[str],
    ldts: str = "load_date",
    source: str = "record_source",
    existing: Stored = None,
    keys_checked: bool = False,
    distinct_keys: bool = False,
    tie: Sequence[str] | None = None,
    by: str | None = None,
    within: str | None = None,
    as_key: Callable[[str], Column] = pack_key,
    ids: Sequence[str] | None = None,
    then: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Rows to append to a link: one per link key not yet in ``existing``.

    Rows with a NULL link key or a NULL hub key are not relationships and are
    skipped (optional links are staged with a NULL link key).  ``tie`` orders rows
    of one link key and load timestamp (the hub keys, unless given).
    """
    frames = _as_list(new)
    cols = [pk, *fks, ldts, source]
    if ids is not None or then is not None:
        if ids is None or not (keys_checked and distinct_keys and len(frames) == 1):
            raise ValueError("narrow rows need their ids and checked, distinct keys")
        # Stored ids take so few bytes that their files' size would let millions of
        # rows be broadcast through the driver.
        stored = None if existing is None else [part.hint("merge") for part in _as_list(existing)]
        rows = _not_stored(frames[0].select(*ids, ldts, source), stored, list(ids))
        return rows if then is None else then(rows)
    not_null = F.col(pk).isNotNull()
    for fk in fks:
        not_null = not_null & F.col(fk).isNotNull()
    if not keys_checked:
        frames = [f if by is not None else f.select(*([within] if within else []), *cols) for f in frames]
        frames = [f.filter(not_null) for f in frames]
    if by is not None:
        if existing is not None or len(frames) != 1:
            raise ValueError("rows dealt out by a hub key are compared with no stored ones")
        # The link key stands for its hub keys where it is narrower than they are.
        same = [pk] if len(fks) > 3 else [c for c in fks if c != by]
        packed = dict.fromkeys([*fks, *same])
        rows = frames[0].select(*[as_key(c).alias(c) for c in packed], ldts, source).repartition(by)
        w = Window.partitionBy(by, *same).orderBy(ldts)
        return rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).select(*fks)
    if distinct_keys and len(frames) == 1:
        return _not_stored(frames[0].select(*cols), existing, pk)
    rows = _first_per_key(frames, pk, cols, ldts, tie=list(fks) if tie is None else tie, within=[within] if within else [])
    return _not_stored(rows, existing, pk)


def _followed(batch: DataFrame, existing: Stored, cols: Sequence[str], pk: str, ldts: str, source: str) -> DataFrame:
    """The stored rows that a batch row can follow.

    These are, per key, the stored rows at or after the batch's earliest
    timestamp, and per source those of the latest timestamp before it (the
    anchor).  A daily load against years of history keeps about one stored row
    per key and source; late and out-of-order rows keep the sequence they
    need.  A batch row without a timestamp sorts first, so it keeps the
    whole stored sequence of its key.

    The anchors are a hash aggregate over (key, source) with map-side partial
    sums, so a key's long history is reduced where it is read and never sorted.
    Both reads of the stored side join on the key alone, which is how a
    bucketed target is stored: neither shuffles it.
    """
    first_new = batch.groupBy(pk).agg(
        F.min(ldts).alias("_first_new"), F.max(F.col(ldts).isNull()).alias("_all"))
    before = F.col(ldts).isNull() | (F.col(ldts) < F.col("_first_new"))

    def stored(columns: Sequence[str], bounds: DataFrame) -> DataFrame:
        out = None
        for part in _as_list(existing):
            rows = part.select(*columns).join(bounds, pk, "inner")
            out = rows if out is None else out.unionByName(rows)
        return out

    anchors = (
        stored([pk, source, ldts], first_new).filter(before)
        .groupBy(pk, source).agg(F.max(ldts).alias("t"))
        .groupBy(pk).agg(F.collect_list(F.struct(F.col(source).alias("s"), "t")).alias("_anchors"))
    )
    bounds = first_new.join(anchors, pk, "left")
    last = F.exists("_anchors", lambda a: a["s"].eqNullSafe(F.col(source)) & a["t"].eqNullSafe(F.col(ldts)))
    return (
        stored(cols, bounds).filter(F.col("_all") | ~before | F.coalesce(last, F.lit(False)))
        .drop("_first_new", "_all", "_anchors")
    )


def sat_rows(
    new: DataFrame,
    pk: str,
    hashdiff: str,
    payload: Sequence[str],
    ldts: str = "load_date",
    source: str = "record_source",
    existing: Stored = None,
    tie: Callable[[], Column] | None = None,
    bucket: Callable[[Column], Column] | None = None,
    limit: int | None = None,
    keys_checked: bool = False,
) -> DataFrame:
    """Rows to append to a satellite (one row per change of the hashdiff).

    ``tie``    optional expression over payload columns that orders rows with
               the same ``ldts`` (e.g. a status lifecycle rank); hashdiff is
               the last tie-break, so the order is total.
    ``bucket`` optional function of the ``ldts`` column that splits one key's
               history into several window partitions (see
               ``vaultline.operators.sequence``); results are identical.
    ``limit``  with ``bucket``: rows of one key and bucket above which the bucket
               is split again, at sampled positions.
    """
    cols = [pk, hashdiff, *payload, ldts, source]
    tie_col = tie() if tie is not None else F.lit(0)
    batch = new.select(*cols)
    if not keys_checked:
        batch = batch.filter(F.col(pk).isNotNull())
    batch = (
        batch
        .withColumn("_tie", tie_col)
        .withColumn("_origin", F.lit(1))
    )
    rows = batch
    if existing is not None:
        rows = _followed(batch, existing, cols, pk, ldts, source).withColumn("_tie", tie_col).withColumn(
            "_origin", F.lit(0)).unionByName(batch)
    order = [F.col(ldts), F.col("_tie"), F.col(hashdiff), F.col("_origin")]
    with_prev = previous_value(
        rows,
        [pk, source],
        order,
        hashdiff,
        "_prev_hd",
        bucket=bucket(F.col(ldts)) if bucket is not None else None,
        limit=limit,
    )
    return (
        with_prev.filter(
            (F.col("_origin") == 1)
            & (F.col("_prev_hd").isNull() | (F.col("_prev_hd") != F.col(hashdiff)))
        )
        .select(*cols)
    )


def load_all(
    rows_fn: Callable[..., DataFrame],
    batches: Sequence,
    **kwargs,
) -> DataFrame:
    """Final target state after loading ``batches`` in order, without disk.

    ``batches`` are the ``new`` arguments of ``rows_fn``.  Useful for tests and
    for the incremental query keys; production appends each result instead.
    """
    target = None
    for b in batches:
        added = rows_fn(b, existing=target, **kwargs)
        target = added if target is None else target.unionByName(added)
    return target
