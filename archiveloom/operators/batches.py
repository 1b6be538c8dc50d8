"""Bounds on the Arrow batches that Python workers hold."""

from __future__ import annotations

from pyspark.sql import SparkSession

# An Arrow batch is held by the JVM and by the Python worker at the same time.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, since long texts may share one, unless the session does."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
