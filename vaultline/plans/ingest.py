"""Ingest queries: feeds written as dated CSV extracts and read back.

They exercise the bronze CSV source end to end on data derived from the
driver tables: Spark writes the extracts into the shared checkpoint folder,
then the feed reader scans the folder with the explicit feed schema.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.constants import BATCH_SPLIT_DAY, LOAD_DATE_1
from vaultline.functions.dates import midnight, ntz
from vaultline.plans import staging as S
from vaultline.plans.warehouse import Warehouse
from vaultline.session import scratch_folder
from vaultline.sources.feeds import NewExtracts, scan_feed, scan_union_extracts, write_extract
from vaultline.sources.stored import StoredTable

EXTRACT_1 = "2024-02-01"
EXTRACT_2 = "2024-02-02"


def _landing(spark: SparkSession) -> str:
    return scratch_folder(spark, "landing", uuid.uuid4().hex)


def scan_feed_query(spark: SparkSession, root: str) -> DataFrame:
    """Patients feed -> CSV extract -> typed scan -> staging."""
    landing = _landing(spark)
    write_extract(Warehouse(spark, root).feed("patients"), landing, "patients", EXTRACT_1)
    return S.stg_patients(scan_feed(spark, landing, "patients"), ntz(LOAD_DATE_1))


def scan_union_extracts_query(spark: SparkSession, root: str) -> DataFrame:
    """Two dated extracts of the status history (what was known at the split
    day, then everything), read back as one union with ``extract_date``."""
    landing = _landing(spark)
    hist = Warehouse(spark, root).feed("appointment_status_history")
    write_extract(hist.filter(F.col("status_at") < midnight(BATCH_SPLIT_DAY)), landing,
                  "appointment_status_history", EXTRACT_1)
    write_extract(hist, landing, "appointment_status_history", EXTRACT_2)
    return scan_union_extracts(spark, landing, "appointment_status_history")


def scan_new_extracts_query(spark: SparkSession, root: str) -> DataFrame:
    """Runs over a growing landing folder, each reading only the extracts that
    are new to it: (run, rows of the status history).  The second extract has
    its columns in another order and one more; nothing is new to the third run."""
    landing = _landing(spark)
    entity = "appointment_status_history"
    manifest = StoredTable(spark, scratch_folder(spark, "manifest", uuid.uuid4().hex))
    loaded = StoredTable(spark, scratch_folder(spark, "stored", uuid.uuid4().hex, entity))
    hist = Warehouse(spark, root).feed(entity)
    arrivals = [
        (EXTRACT_1, hist.filter(F.col("status_at") < midnight(BATCH_SPLIT_DAY))),
        (EXTRACT_2, hist.select(F.lit("x").alias("note"), "status_at", "appointment_id", "status")),
        (None, None),
    ]
    for run, (day, rows) in enumerate(arrivals, 1):
        if day:
            write_extract(rows, landing, entity, day)
        new = NewExtracts(spark, landing, entity, manifest)
        loaded.append(new.rows().select(F.lit(run).alias("run"), "*"), f"run-{run}")
        new.done()
    return loaded.read()


INGEST = {
    "scan_new_extracts": scan_new_extracts_query,
    "scan_feed": scan_feed_query,
    "scan_union_extracts": scan_union_extracts_query,
}
