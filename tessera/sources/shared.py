"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or on a single machine (tests) a temporary folder where it is unset; elsewhere an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        at = spark.conf.get("spark.checkpoint.dir", None)
        if not at and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(at or "file://" + tempfile.mkdtemp(prefix="tessera-"))
    return sc.getCheckpointDir()
