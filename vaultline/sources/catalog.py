"""The warehouse in the catalog: one database per layer, one view per table.

A view selects the folders of its table's newest commit, so it is switched by
``CREATE OR REPLACE VIEW`` after a run has succeeded, table by table, and
queries that started before keep reading the folders they resolved.  Sessions of one
application, and applications with a common metastore, see the views; elsewhere
``publish`` declares them again from the commit logs, without reading data.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from vaultline.sources.sinks import stored_table
from vaultline.sources.stored import StoredTable, _Files

# The layers of the warehouse, each a schema of its own.
LAYERS = ("staging", "raw_vault", "business_vault", "gold", "tests")


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def view_query(table: StoredTable) -> str | None:
    """SQL over the newest commit's folders; None for a table without one."""
    entry = table.commit()
    if entry is None:
        return None
    schema = StructType.fromJson(entry["schema"])
    columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
    if not entry["parts"]:
        nulls = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
        return f"SELECT {nulls} WHERE FALSE"
    if not entry["partition_by"]:
        selects = [f"SELECT {columns} FROM parquet.`{table.path}/{p}`" for p in entry["parts"]]
        return " UNION ALL ".join(selects)
    # Partitions live in the folders of the commits that wrote them: a folder is
    # read with its live partitions only (pruned before any file is opened).
    by = entry["partition_by"][0]
    folders: dict[str, list[str]] = {}
    for p in entry["parts"]:
        folder, leaf = p.rsplit("/", 1)
        folders.setdefault(folder, []).append(leaf.split("=", 1)[1])
    return " UNION ALL ".join(
        f"SELECT {columns} FROM parquet.`{table.path}/{folder}` "
        f"WHERE CAST(`{by}` AS STRING) IN ({', '.join(_quoted(v) for v in sorted(values))})"
        for folder, values in sorted(folders.items()))


def publish(spark: SparkSession, root: str, layers: Iterable[str] = LAYERS, prefix: str = "") -> list[str]:
    """Point the catalog at the newest commit of every table under ``root``;
    returns the view names (``<prefix><layer>.<table>``)."""
    files, done = _Files(spark, root), []
    for layer in layers:
        names = files.names(f"{root.rstrip('/')}/{layer}")
        if not names:
            continue
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{prefix}{layer}`")
        for name in sorted(names):
            query = view_query(stored_table(spark, root, layer, name))
            if query:
                spark.sql(f"CREATE OR REPLACE VIEW `{prefix}{layer}`.`{name}` AS {query}")
                done.append(f"{prefix}{layer}.{name}")
    return done
