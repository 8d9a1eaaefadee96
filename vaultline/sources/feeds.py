"""Bronze CSV feeds: one folder per entity, dated extracts unioned.

Feeds are read with an explicit schema (codes stay strings, so leading zeros
survive; no schema inference pass over the data), ``header`` on, and
``FAILFAST`` so a malformed extract stops the load instead of silently
producing NULLs.  Both layouts are read:

* flat dated files ``<root>/<entity>/<entity>_<yyyy-MM-dd>.csv``;
* Spark-written partitions ``<root>/<entity>/extract_date=<yyyy-MM-dd>/part-*.csv``.

Columns are bound by name.  Spark binds CSV columns by position, so the header
line of every file is read first (one small read per file, side by side, next to
the listing that a scan does anyway); files with the same header become one
scan whose schema has that file's order, and the scans are united by the feed's
names.  A missing or repeated column stops the load, columns that the feed does not
have are reported and not read (column pruning keeps them out of the parser).
Quotes inside a quoted field are doubled (RFC 4180).

Integer ids are read as text, because nullable ids written by pandas arrive
as ``12.0``: digits with an optional zero fraction become BIGINT exactly (no
detour over DOUBLE, which changes ids above 2**53); anything else stops the
load.

``NewExtracts`` reads only files that no finished run has read: the files
(path, length, modification time) of each run are appended to a stored table when
the run is done.
"""

from __future__ import annotations

import csv
import logging
import os
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.sources.stored import StoredTable

FEED_SCHEMAS: dict[str, str] = {
    "facilities": "facility_id BIGINT, cnes_code STRING, name STRING, address STRING, "
                  "city STRING, state STRING, phone STRING",
    "specialties": "specialty_id BIGINT, name STRING",
    "insurance_providers": "insurance_provider_id BIGINT, name STRING, "
                           "ans_registration_number STRING",
    "exam_types": "exam_type_id BIGINT, name STRING, category STRING, "
                  "self_pay_price DECIMAL(10,2), tuss_code STRING",
    "practitioners": "practitioner_id BIGINT, name STRING, license_number STRING, "
                     "specialty_id BIGINT, facility_id BIGINT, phone STRING, email STRING",
    "patients": "patient_id BIGINT, name STRING, cpf STRING, birth_date DATE, sex STRING, "
                "phone STRING, email STRING, address STRING, city STRING, state STRING, "
                "created_at TIMESTAMP_NTZ",
    "partner_patients": "partner_patient_id BIGINT, cpf STRING, name STRING, phone STRING, "
                        "email STRING, city STRING, state STRING, registered_at TIMESTAMP_NTZ",
    "appointments": "appointment_id BIGINT, rescheduled_from_id BIGINT, patient_id BIGINT, "
                    "practitioner_id BIGINT, specialty_id BIGINT, facility_id BIGINT, "
                    "scheduled_at TIMESTAMP_NTZ, visit_type STRING, "
                    "insurance_provider_id BIGINT, current_status STRING, "
                    "created_at TIMESTAMP_NTZ",
    "appointment_status_history": "appointment_id BIGINT, status STRING, "
                                  "status_at TIMESTAMP_NTZ",
    "exams": "exam_id BIGINT, source_appointment_id BIGINT, patient_id BIGINT, "
             "exam_type_id BIGINT, facility_id BIGINT, scheduled_at TIMESTAMP_NTZ, "
             "visit_type STRING, insurance_provider_id BIGINT, current_status STRING, "
             "created_at TIMESTAMP_NTZ",
    "exam_status_history": "exam_id BIGINT, status STRING, status_at TIMESTAMP_NTZ",
    "payments": "payment_id BIGINT, reference_type STRING, reference_id BIGINT, "
                "amount DECIMAL(10,2), payment_method STRING, payment_status STRING, "
                "paid_at TIMESTAMP_NTZ",
    "patient_feedback": "feedback_id BIGINT, appointment_id BIGINT, cpf STRING, rating INT, "
                        "comments STRING, submitted_at TIMESTAMP_NTZ",
}

_DATE_IN_NAME = r"(\d{4}-\d{2}-\d{2})"
_ID = r"^\s*[+-]?\d+(\.0*)?\s*$"
_HEADER_BYTES = 1 << 16


class FeedHeaderError(ValueError):
    """A file's header lacks a column of the feed, or names one twice."""


def _columns(entity: str) -> list[tuple[str, str]]:
    """(name, type) of the feed's columns."""
    return [tuple(f.split(maxsplit=1)) for f in FEED_SCHEMAS[entity].split(", ")]


def _exact_id(name: str) -> Column:
    c = F.col(name)
    return (
        F.when(c.isNull(), F.lit(None).cast("bigint"))
        .when(c.rlike(_ID), c.cast("decimal(38,9)").cast("bigint"))
        .otherwise(F.raise_error(F.concat(F.lit(f"{name} is not an integer id: "), c)).cast("bigint"))
        .alias(name)
    )


def extract_files(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """(path, length, modified) of the feed's files: a listing, no file is opened."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
        .load(os.path.join(root, entity))
        .select("path", "length", F.col("modificationTime").cast("long").alias("modified"))
    )


def read_headers(spark: SparkSession, paths: Iterable[str]) -> dict[str, tuple[str, ...]]:
    """The column names (lower case, as SQL resolves them) in the first line of
    each file; files without one (empty ones) are left out."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def first_line(path: str) -> str:
        p = jvm.org.apache.hadoop.fs.Path(path)
        stream = p.getFileSystem(conf).open(p)
        try:
            held = jvm.org.apache.commons.io.input.BoundedInputStream(stream, _HEADER_BYTES)
            return jvm.org.apache.commons.io.IOUtils.toString(held, "UTF-8")
        finally:
            stream.close()

    def header(path: str) -> tuple[str, ...]:
        text = first_line(path).lstrip("\ufeff")
        return tuple(c.strip().lower() for c in next(csv.reader(text.splitlines()[:1]), ())) if text.strip() else ()

    paths = list(paths)
    with ThreadPoolExecutor(max_workers=max(1, min(32, len(paths)))) as pool:
        return {p: h for p, h in zip(paths, pool.map(header, paths)) if h}


def _scan(spark: SparkSession, entity: str, header: tuple[str, ...], paths: list[str]) -> DataFrame:
    """One scan of files with the same header; the feed's columns by name."""
    types = dict(_columns(entity))
    schema = ", ".join(
        f"`{n}` {'STRING' if types.get(n, 'STRING') == 'BIGINT' else types.get(n, 'STRING')}" for n in header)
    return (
        spark.read.schema(schema)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("mode", "FAILFAST")
        .option("timestampNTZFormat", "yyyy-MM-dd[ ]['T']HH:mm:ss[.SSSSSS][.SSS]")
        .csv(paths)
    )


def scan_files(spark: SparkSession, entity: str, paths: Iterable[str], dated: bool = False) -> DataFrame:
    """The rows of the given files of a feed, columns bound by name; ``dated`` adds
    ``extract_date`` from the file's or folder's name."""
    wanted = [n for n, _ in _columns(entity)]
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in read_headers(spark, paths).items():
        groups.setdefault(header, []).append(path)
    out = None
    for header, files in sorted(groups.items()):
        missing = [n for n in wanted if n not in header]
        twice = sorted({n for n in header if header.count(n) > 1})
        if missing or twice:
            raise FeedHeaderError(f"{entity}: {files[0]} lacks {missing or 'nothing'}, names twice {twice or 'nothing'}")
        extra = [n for n in header if n not in wanted]
        if extra:
            logging.getLogger(__name__).warning("%s: columns %s of %d files are not read", entity, extra, len(files))
        rows = _scan(spark, entity, header, files)
        columns = [_exact_id(n) if t == "BIGINT" else F.col(n) for n, t in _columns(entity)]
        if dated:
            columns.append(F.to_date(F.regexp_extract(F.col("_metadata.file_path"), _DATE_IN_NAME, 1)).alias("extract_date"))
        part = rows.select(*columns)
        out = part if out is None else out.unionByName(part)
    if out is not None:
        return out
    return spark.createDataFrame([], FEED_SCHEMAS[entity] + (", extract_date DATE" if dated else ""))


def _paths(files: DataFrame) -> list[str]:
    return [r.path for r in files.select("path").orderBy("path").toLocalIterator()]


def scan_feed(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """All extracts of one feed as one DataFrame (the feed's columns only)."""
    return scan_files(spark, entity, _paths(extract_files(spark, root, entity)))


def latest_rows(extracts: DataFrame, key: str) -> DataFrame:
    """Per key the row of the latest extract -- one aggregate (``max_by``,
    partial aggregation map-side) instead of a window."""
    others = [c for c in extracts.columns if c != key]
    picked = extracts.groupBy(key).agg(F.max_by(F.struct(*others), F.col("extract_date")).alias("_r"))
    return picked.select(key, *[F.col("_r")[c].alias(c) for c in others])


def scan_union_extracts(
    spark: SparkSession, root: str, entity: str, latest_by: str | None = None
) -> DataFrame:
    """All extracts with their ``extract_date`` (from the file or folder name);
    ``latest_by`` keeps, per key, only the row of the latest extract."""
    df = scan_files(spark, entity, _paths(extract_files(spark, root, entity)), dated=True)
    return df if latest_by is None else latest_rows(df, latest_by)


class NewExtracts:
    """The extracts of a feed that no finished run has read.

    ``rows()`` scans them; ``done()`` notes them in ``manifest`` once their rows are
    loaded.  A run that dies before ``done()`` reads them again (the loaders
    append nothing twice).  A file is known by path, length and modification
    time, so one that was replaced is read again.
    """

    def __init__(self, spark: SparkSession, root: str, entity: str, manifest: StoredTable):
        self.spark, self.entity, self.manifest = spark, entity, manifest
        files = extract_files(spark, root, entity).withColumn("entity", F.lit(entity))
        known = manifest.read()
        if known is not None:
            files = files.join(known, ["entity", "path", "length", "modified"], "left_anti")
        # A listing, kept on the driver like the one of any scan.
        self.files = [tuple(r) for r in files.select("entity", "path", "length", "modified").orderBy("path").collect()]

    def rows(self) -> DataFrame:
        """The unseen files' rows with ``extract_date``; no file is opened if there
        is none."""
        return scan_files(self.spark, self.entity, [f[1] for f in self.files], dated=True)

    def done(self) -> int:
        """Note the files as read; returns how many."""
        if self.files:
            noted = self.spark.createDataFrame(self.files, "entity string, path string, length long, modified long")
            self.manifest.append(noted.coalesce(1), f"{self.entity}-{uuid.uuid4().hex}")
            self.manifest.compact()
        return len(self.files)


def write_extract(df: DataFrame, root: str, entity: str, extract_date: str) -> str:
    """Write one dated extract of a feed as CSV (Spark partition layout)."""
    path = os.path.join(root, entity, f"extract_date={extract_date}")
    df.write.mode("overwrite").option("header", True).option("escape", '"').option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    return path
