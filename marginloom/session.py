"""Session settings the operators rely on.

Only runtime SQL settings are touched, so ``configure`` can be applied to any
session handed in by a cluster, a notebook or a test.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # AQE picks broadcast joins from measured sizes and splits skewed join partitions;
    # the force flag keeps the split even where it costs one more exchange.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a side that lies by some of a join's keys isn't moved again for the others
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for written stages that the cluster names in ``spark.checkpoint.dir``.

    A local session without one gets a fresh folder; on a cluster, whose executors would each write to a disk of
    their own, its absence is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="marginloom-")
