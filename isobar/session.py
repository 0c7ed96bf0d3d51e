"""Spark session helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (runs are UTC), AQE for runtime
# re-planning (coalescing, skew splitting, broadcast conversion), no UI server.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "isobar", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    conf["spark.driver.memory"] = os.environ.get("ISOBAR_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder under the cluster's shared checkpoint location.

    The location comes from ``spark.checkpoint.dir``.  Only when a local
    session (tests) has none is a fresh scratch folder created and registered;
    on a cluster a missing setting is an error, as executors do not share the
    driver's disk.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="isobar-ckpt-"))
        root = sc.getCheckpointDir()
    root = root.rstrip("/")
    return f"{root}/{name}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``DataFrame.checkpoint()`` has a (shared) directory."""
    return shared_dir(spark, "")


def cluster_conf(input_bytes: int, cores: int, partition_mb: int = 256, max_width: int = 1_000_000) -> dict[str, str]:
    """Settings sized for a large job (pass to ``get_session(extra=...)``).

    Input splits and shuffle partitions target ``partition_mb`` each, so a
    task's working set fits in executor memory and spills stay rare; the
    initial shuffle width covers the input (at least 3 tasks per core, at most
    ``max_width`` partitions: map-status bookkeeping grows with their number) and AQE
    merges small partitions and splits skewed ones (a key with a third of all
    rows is cut at the advisory size).
    """
    part = partition_mb * 1024 * 1024
    width = max(3 * cores, min(-(-int(input_bytes) // part), max_width))
    return {
        "spark.sql.files.maxPartitionBytes": str(part),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(part),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * part),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        # let a table bucketed on a subset of the join keys join without a
        # shuffle (remap: native and weights bucketed by src_id, joined on
        # (method, src_id)); AQE's skew-join still splits hot partitions
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
    }


def ship_package(spark: SparkSession) -> None:
    """Make ``isobar`` importable on every executor (once per SparkContext).

    Pandas functions are pickled by reference to their module, so Python
    workers must import the package.  It is zipped on the driver and handed to
    Spark (``addPyFile``, the runtime form of ``--py-files``), which copies it
    to each executor.
    """
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_isobar_shipped", False):
        return
    import isobar
    pkg_dir = os.path.dirname(os.path.abspath(isobar.__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="isobar-pyfiles-"), "isobar.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(out)
    sc._isobar_shipped = True
