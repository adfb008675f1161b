"""Session helpers: where lineage is cut and where written tables live."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may fall
    back to a temporary folder: on a cluster that folder would sit on one machine.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY)
    current = context.getCheckpointDir()
    if named:
        if current is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if current is not None:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return context.getCheckpointDir().rstrip("/")


def workspace(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so later reads see the same rows in the same partitions."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
