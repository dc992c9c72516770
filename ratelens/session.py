"""Session settings the library reads. It never builds a session of its own."""

from __future__ import annotations

from pyspark.sql import SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session (``spark.checkpoint.dir``
    or one set on the SparkContext). Library code only ever writes there; it
    never falls back to a machine-local folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a folder shared by the cluster")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir()
