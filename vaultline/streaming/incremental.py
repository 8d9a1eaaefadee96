"""Incremental vault loads driven by Structured Streaming.

A landing folder of staged batches (or any streaming DataFrame) is consumed
with ``foreachBatch``; each micro-batch goes through the same pure loader as a
batch run (``hub_rows`` / ``link_rows`` / ``sat_rows``) against the stored
target, and the proven-new rows are appended under the id of the micro-batch.
A micro-batch replayed after a failure is found in the target's commit log and
skipped, one that died while writing is invisible: appends are exactly-once.
Small parts are merged as they pile up.  The checkpoint location must be on shared
storage (``spark.checkpoint.dir``).
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from vaultline.session import scratch_path
from vaultline.sources.stored import StoredTable


def vault_stream(
    stream: DataFrame,
    rows_fn: Callable[..., DataFrame],
    target_path: str,
    checkpoint_location: str | None = None,
    available_now: bool = True,
    **loader_kwargs,
) -> StreamingQuery:
    """Start a stream that appends ``rows_fn(batch, existing=target)`` per batch.

    The stream's checkpoint defaults to a folder under the shared
    ``spark.checkpoint.dir`` named after the target's path and the loader.
    """
    if checkpoint_location is None:
        # Named after the whole path and the loader: two targets that end in
        # the same name must not share a checkpoint.
        whole = f"{target_path.rstrip('/')}|{getattr(rows_fn, '__name__', repr(rows_fn))}"
        name = f"{target_path.rstrip('/').split('/')[-1]}-{sha256(whole.encode()).hexdigest()[:16]}"
        checkpoint_location = scratch_path(stream.sparkSession, "streams", name)

    stream_id = sha256(checkpoint_location.encode()).hexdigest()[:16]

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        target = StoredTable(batch.sparkSession, target_path)
        target.append(rows_fn(batch, existing=target.read(), **loader_kwargs), f"{stream_id}-{batch_id}")
        target.compact()

    writer = stream.writeStream.foreachBatch(load_batch).option(
        "checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()


def landing_stream(spark: SparkSession, path: str, schema: str,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of parquet batches dropped into a landing folder."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)
