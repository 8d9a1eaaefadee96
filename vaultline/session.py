"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for correctness and for scale.  Shuffle partitions
# default to the core count locally; on a cluster pass the real number
# (AQE coalesces small partitions and splits skewed join partitions).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A union of two inputs hash-partitioned on the same keys would otherwise
    # report both partitionings; once AQE coalesces them to different
    # partition counts the planner fails ("PartitioningCollection requires
    # all of its partitionings have the same numPartitions").  Chained
    # incremental loads (stored rows + appended rows, loaded again) hit it.
    "spark.sql.unionOutputPartitioning": "false",
}

# Local mode runs everything in the driver JVM; on a cluster the launcher
# sets memory per executor instead.
LOCAL_CONF = {
    "spark.driver.memory": "16g",
}


def get_spark(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "vaultline",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        conf.update(LOCAL_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


_LOCAL_ROOTS: dict[int, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session.  Only when it is unset (local runs, tests) one
    scratch folder per Spark context is created and registered; on a cluster
    the setting must point at shared storage so that written tables survive
    executor loss.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            root = None
    # local-cluster has executors of its own: it counts as a cluster.
    if not root and not sc.master.split("[")[0] == "local":
        raise RuntimeError(
            "spark.checkpoint.dir is not set: on a cluster, written tables must go "
            "to shared storage; set it to a folder every executor can reach"
        )
    if not root:
        key = id(sc._jsc)
        if key not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[key] = tempfile.mkdtemp(prefix="vaultline-ckpt-")
        root = _LOCAL_ROOTS[key]
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # noqa: BLE001 - some sessions reject core settings
            pass
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), *parts)


# Scratch folders that queries wrote and nobody has released yet.
_SCRATCH: list[tuple[SparkSession, str]] = []


def scratch_folder(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder that ``release_scratch`` deletes."""
    path = scratch_path(spark, *parts)
    _SCRATCH.append((spark, path))
    return path


def release_scratch() -> None:
    """Delete every scratch folder handed out so far.

    Call only when no DataFrame that reads them is needed any more (a harness
    after it has consumed each query's result)."""
    while _SCRATCH:
        spark, path = _SCRATCH.pop()
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
