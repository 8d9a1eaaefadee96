"""Where tables live: ``<root>/<layer>/<model>``, each a stored table.

Full-refresh tables are replaced as a whole, insert-only (vault) targets get
batches appended, see ``vaultline.sources.stored``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from vaultline.sources.stored import StoredTable


def table_path(root: str, layer: str, name: str) -> str:
    return os.path.join(root, layer, name)


def stored_table(spark: SparkSession, root: str, layer: str, name: str, **options) -> StoredTable:
    return StoredTable(spark, table_path(root, layer, name), **options)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table at ``path``, or None when it does not exist yet."""
    return StoredTable(spark, path).read()


def delete(spark: SparkSession, path: str) -> None:
    """Recursively delete ``path`` on its file system (no-op if absent)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
