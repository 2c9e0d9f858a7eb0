"""Cutting lineage in shared storage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="recspark-")
    sc.setCheckpointDir(path)
    return path


def stable(df: DataFrame) -> DataFrame:
    """Checkpoint ``df``, so that a lost executor cannot change rows that were already counted on."""
    sc = df.sparkSession.sparkContext
    path = shared_dir(df.sparkSession)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return df.checkpoint()
