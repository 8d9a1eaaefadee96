"""Parquet table access for a warehouse root (one ``<name>.parquet`` each)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Tables:
    """Lazily opened parquet tables under ``root``.

    Each table is opened once per ``Tables`` object so repeated uses share the
    same relation (Catalyst then prunes columns and pushes filters per use).
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self._frames: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(
                os.path.join(self.root, f"{name}.parquet")
            )
        return self._frames[name]
