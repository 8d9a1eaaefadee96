"""Stored tables: versions, batches and partitions behind a commit log.

A stored table is a folder

    <path>/data/part_version=<id>/...      parquet, written once, never changed
    <path>/_commits/<number>.json          one small file per commit

A commit names the data folders that make up the table from then on.  Data is
written first, and the commit file is renamed into place last, so a run that dies
in between leaves the table as it was (its folder is an orphan that the next
commit removes).  Readers resolve the newest commit when they open the table
and keep reading its folders while later commits are made: the folders of
the last ``KEEP`` commits before the newest stay on disk.

* ``replace``             full refresh;
* ``append``              one batch, by id: a batch that is in the log already is
                          not written again, so a retried load adds nothing;
* ``replace_partitions``  new contents of the named partitions, the folders of
                          all others stay as they are;
* ``compact``             the same rows in fewer folders: the small parts that batches
                          leave behind are merged, large ones are left alone.

``buckets=(key, n, database)`` writes every part clustered and sorted by the key
into ``n`` files, declared as an external table of its own in ``database``.
``parts()`` gives the frames part by part; a join of one on the key does not
shuffle the stored rows.

``derived=f`` makes ``read()`` return ``f`` of the stored rows: columns that follow
from the stored ones (hash keys from their ids) are part of the table without
being on disk.  Like ``buckets`` it is named when the table is opened; ``parts()``,
the commit log and the catalog's views have the rows as they are stored.

One writer per table at a time; a second one fails at its commit, because the
number is taken.  Row counts are observed while the rows are written.
"""

from __future__ import annotations

import json
import uuid
from hashlib import sha256
from collections.abc import Callable, Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

VERSION = "part_version"
KEEP = 2
#: Hash keys are hex text: only an entropy code makes them smaller.
CODEC = "zstd"


class CommitConflict(RuntimeError):
    """Another writer has committed to the table since it was opened."""


class _Files:
    """The few file-system calls a commit log needs (any Hadoop file system)."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.gateway = spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def names(self, folder: str) -> list[str]:
        p = self.path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(p)] if self.fs.exists(p) else []

    def read(self, file: str) -> str:
        stream = self.fs.open(self.path(file))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, file: str, text: str) -> None:
        """Write ``file`` as a whole, or fail if there is one."""
        draft = self.path(f"{file}.{uuid.uuid4().hex}.tmp")
        out = self.fs.create(draft, False)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        kind = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        plain = self.gateway.new_array(kind, 0)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.conf)
        try:
            context.rename(draft, self.path(file), plain)
        except Exception as e:
            self.fs.delete(draft, False)
            if self.fs.exists(self.path(file)):
                raise CommitConflict(f"{file} exists already") from e
            raise

    def delete(self, folder: str) -> None:
        self.fs.delete(self.path(folder), True)


class StoredTable:
    """A table at ``path``; see the module's description."""

    def __init__(self, spark: SparkSession, path: str, keep: int = KEEP,
                 buckets: tuple[str, int, str] | None = None,
                 derived: Callable[[DataFrame], DataFrame] | None = None):
        self.spark, self.path, self.keep, self.buckets = spark, path.rstrip("/"), keep, buckets
        self.derived = derived
        self.files = _Files(spark, self.path)

    # ------------------------------------------------------------- commits

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.files.names(f"{self.path}/_commits") if n.endswith(".json"))

    def commit(self, version: int | None = None) -> dict | None:
        """The newest (or a given) commit; None for a table without one."""
        if version is None:
            known = self.versions()
            if not known:
                return None
            version = known[-1]
        return json.loads(self.files.read(f"{self.path}/_commits/{version:08d}.json"))

    def available(self, version: int | None) -> bool:
        """Whether the folders of an earlier commit are still kept."""
        known = self.versions()
        return bool(known) and version in known and version >= known[-1] - self.keep

    def _next(self, now: dict | None, action: str, parts: list[str], schema: StructType, partition_by: list[str],
              rows: int, batch: str | None, meta: dict | None, sizes: dict[str, int] | None = None) -> dict:
        entry = {
            "version": now["version"] + 1 if now else 1, "action": action, "parts": parts,
            "schema": schema.jsonValue(), "partition_by": partition_by, "rows": rows, "sizes": sizes or {},
            "batches": {**(now["batches"] if now else {}), **({batch: rows} if batch else {})},
            "meta": meta or {},
        }
        self.files.create(f"{self.path}/_commits/{entry['version']:08d}.json", json.dumps(entry))
        self._clean(entry)
        return entry

    def _clean(self, newest: dict) -> None:
        """Remove what no commit after the last ``keep`` refers to."""
        kept = set(newest["parts"])
        for v in range(max(1, newest["version"] - self.keep), newest["version"]):
            kept.update(self.commit(v)["parts"])
        for folder in self.files.names(f"{self.path}/data"):
            part = f"data/{folder}"
            if part in kept:
                continue
            live = [p for p in kept if p.startswith(part + "/")]
            if not live:
                if self.buckets:
                    self.spark.sql(f"DROP TABLE IF EXISTS {self._name(part)}")
                self.files.delete(f"{self.path}/{part}")
                continue
            for sub in self.files.names(f"{self.path}/{part}"):
                if "=" in sub and f"{part}/{sub}" not in live:
                    self.files.delete(f"{self.path}/{part}/{sub}")

    # -------------------------------------------------------------- writing

    def _write(self, df: DataFrame, partition_by: list[str], watch: dict | None = None) -> tuple[list[str], dict]:
        """(data folders, observed values) of newly written rows."""
        part = f"data/{VERSION}={uuid.uuid4().hex}"
        seen = Observation(f"stored-{uuid.uuid4().hex}")
        measures = [F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in (watch or {}).items()]]
        watched = df.observe(seen, *measures)
        if self.buckets:
            key, n, database = self.buckets
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
            watched.repartition(n, key).write.bucketBy(n, key).sortBy(key).format("parquet").option("compression", CODEC).option(
                "path", f"{self.path}/{part}").saveAsTable(self._name(part))
        else:
            w = watched.write.option("compression", CODEC)
            if partition_by:
                w = w.partitionBy(*partition_by)
            w.parquet(f"{self.path}/{part}")
        parts = [part]
        if partition_by:
            parts = [f"{part}/{n}" for n in self.files.names(f"{self.path}/{part}") if "=" in n]
        try:
            values = seen.get
        except Py4JJavaError:  # a plan found empty at run time loses its observed values
            values = self._rows(parts, df.schema).agg(*measures).first().asDict()
        return parts, values

    def replace(self, df: DataFrame, partition_by: Iterable[str] = (), meta: dict | None = None,
                watch: dict | None = None) -> dict:
        """Make ``df`` the whole contents.  Partitioned tables are partitioned by
        one column or more; the first one names the partitions.  ``watch`` maps
        names to aggregates observed on the way (returned as ``watched``)."""
        now = self.commit()
        by = list(partition_by)
        parts, seen = self._write(df, by, watch)
        entry = self._next(now, "replace", parts, df.schema, by, seen.get("n", 0), None, meta,
                           {} if by else {parts[0]: seen.get("n", 0)})
        return {**entry, "watched": seen}

    def append(self, df: DataFrame, batch: str | None = None, meta: dict | None = None) -> int:
        """Add the rows of a batch; returns how many.  A batch id that the log
        holds already is skipped without running the query."""
        now = self.commit()
        if now and batch in now["batches"]:
            return 0
        by = now["partition_by"] if now else []
        if by:
            raise ValueError("partitioned tables are changed by replace_partitions")
        parts, seen = self._write(df, [])
        n = seen.get("n", 0)
        if now and not n:
            parts = []  # the log has the batch; its empty folder goes
        self._next(now, "append", [*(now["parts"] if now else []), *parts],
                   StructType.fromJson(now["schema"]) if now else df.schema, [], n, batch, meta,
                   {**(now["sizes"] if now else {}), **{p: n for p in parts}})
        return n

    def replace_partitions(self, df: DataFrame, values: Iterable, meta: dict | None = None) -> dict:
        """New contents of the partitions ``values`` (those without rows in
        ``df`` go); ``df`` must not have rows of other partitions."""
        now = self.commit()
        if not now or not now["partition_by"]:
            raise ValueError(f"{self.path} is not a partitioned table")
        column = now["partition_by"][0]
        names = {f"{column}={v}" for v in values}
        parts, seen = self._write(df, now["partition_by"])
        odd = [p for p in parts if p.rsplit("/", 1)[1] not in names]
        if odd:
            raise ValueError(f"rows outside the replaced partitions: {odd[:3]}")
        kept = [p for p in now["parts"] if p.rsplit("/", 1)[1] not in names]
        return self._next(now, "partitions", kept + parts, StructType.fromJson(now["schema"]), now["partition_by"],
                          seen.get("n", 0), None, meta)

    def compact(self, most: int = 8) -> int:
        """Merge small parts of an appended table that has more than ``most``;
        returns how many were merged.

        Parts are taken from the smallest up while the next one has no more
        rows than those taken so far: equal batches are merged together, a large
        part only once as much has been added, so a row is rewritten
        about log(batches) times."""
        now = self.commit()
        if not now or now["partition_by"] or len(now["parts"]) <= most:
            return 0
        sizes = now["sizes"]
        rising = sorted(now["parts"], key=lambda p: (sizes[p], p))
        taken, rows = rising[:2], sizes[rising[0]] + sizes[rising[1]]
        for p in rising[2:]:
            if sizes[p] > rows:
                break
            taken.append(p)
            rows += sizes[p]
        schema = StructType.fromJson(now["schema"])
        parts, seen = self._write(self._rows(taken, schema), [])
        kept = [p for p in now["parts"] if p not in taken]
        self._next(now, "compact", [*kept, *parts], schema, [], seen.get("n", 0), None, now["meta"],
                   {**{p: sizes[p] for p in kept}, parts[0]: seen.get("n", 0)})
        return len(taken)

    # -------------------------------------------------------------- reading

    def _rows(self, parts: list[str], schema: StructType) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], schema)
        if self.buckets and len(parts) == 1:
            return self._declared(parts[0], schema)
        full = StructType([*schema.fields, StructField(VERSION, StringType())])
        rows = self.spark.read.schema(full).option("basePath", f"{self.path}/data").parquet(
            *[f"{self.path}/{p}" for p in parts])
        return rows.select(*schema.names)

    def _name(self, part: str) -> str:
        """The catalog table of a bucketed part."""
        here = self.path.rsplit("/", 1)[1]
        return f"{self.buckets[2]}.{here}_{sha256(self.path.encode()).hexdigest()[:8]}_{part.rsplit('=', 1)[1]}"

    def _declared(self, part: str, schema: StructType) -> DataFrame:
        """A bucketed part as the catalog's table, declared again in a session
        that doesn't know it."""
        key, n, database = self.buckets
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._name(part)} ({columns}) USING parquet "
            f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {n} BUCKETS LOCATION '{self.path}/{part}'")
        return self.spark.table(self._name(part))

    def read(self, version: int | None = None) -> DataFrame | None:
        """The table as of the newest (or a given) commit; None without one.  The
        frame stays on that commit's folders."""
        entry = self.commit(version)
        if entry is None:
            return None
        rows = self._rows(entry["parts"], StructType.fromJson(entry["schema"]))
        return rows if self.derived is None else self.derived(rows)

    def parts(self) -> list[DataFrame] | None:
        """The newest commit's rows, for bucketed tables part by part."""
        entry = self.commit()
        if entry is None:
            return None
        schema = StructType.fromJson(entry["schema"])
        if not self.buckets or not entry["parts"]:
            return [self._rows(entry["parts"], schema)]
        return [self._declared(p, schema) for p in entry["parts"]]
