"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on; all of them are per session.
SETTINGS = {
    # A repeated JSON key keeps its last value instead of failing the document.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Split hot keys even where a later aggregate would have reused the join's partitioning.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Filters reach the segment log's own planning.
    "spark.sql.python.filterPushdown.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a session and make sure a checkpoint folder is known."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    shared_folder(spark)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for cut lineage and stream state, as the cluster names it.

    Only a local session without the setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="wharf-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run, below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/wharf/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint.

    Meant for summaries that several later steps read; survives lost executors.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
