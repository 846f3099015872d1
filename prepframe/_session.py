"""Session-level helpers: checkpoint folder, lineage cuts, shipping the package."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it only where it is unset.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared file
    system).  A local-mode session without one (tests) gets a fresh folder under
    the system temp dir; a cluster session without one is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="prepframe-ckpt-"))
        return sc.getCheckpointDir()
    raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the reliable checkpoint folder (never localCheckpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``prepframe`` importable in Python workers (once per application).

    Functions run by ``mapInPandas`` are pickled by reference, so executors must be
    able to import this package: it is zipped on the driver and distributed with
    ``addPyFile`` (Spark's own mechanism for Python dependencies).
    """
    import os
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    parent = os.path.dirname(pkg_dir)
    zpath = os.path.join(tempfile.mkdtemp(prefix="prepframe-pyfiles-"), "prepframe.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, parent))
    sc.addPyFile(zpath)
    _SHIPPED.add(key)
