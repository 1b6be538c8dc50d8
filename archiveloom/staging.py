"""Staged tables: how iterative operators cut their lineage.

A staged table is a Parquet table in the shared folder the cluster names in
``spark.checkpoint.dir``, so it outlives any executor. Parquet (rather than an RDD
checkpoint) writes each row once, keeps column statistics and lets later rounds prune.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Column

_SETTING = "spark.checkpoint.dir"
# Spark removes the shuffle files of a query at its end, not when the driver collects garbage
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Rows of a table of a few numbers that may be broadcast.
BROADCAST_NUMBERS = 100_000
# How many times its files a table takes in memory, as far as broadcasts are concerned: a sorted or repeated
# number takes a fraction of a byte in a staged table and 20 to 40 bytes in a broadcast one.
_FACTOR, FACTOR = "spark.sql.sources.fileCompressionFactor", 32.0
# areas to release at the end of each enclosing released() block
_open: ContextVar[tuple[list, ...]] = ContextVar("open", default=())


@contextmanager
def released() -> Iterator[None]:
    """Remove all tables staged inside the block when it ends.

    Results are lazy and read staged tables, so write what is wanted inside the block.
    """
    areas: list[StagingArea] = []
    token = _open.set((*_open.get(), areas))
    try:
        yield
    finally:
        _open.reset(token)
        for area in areas:
            area.release()


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _without_leftovers(spark: SparkSession):
    """What is staged inside leaves no shuffle files behind: the staged table replaces them."""
    return _setting(spark, _CLEANUP, "true")


def sized_joins(spark: SparkSession):
    """Jobs started inside broadcast a table by the memory it takes, not by its compressed files.

    The driver holds every broadcast table, and several at once. What is larger than it seemed is shuffled;
    adaptive execution still broadcasts what it has measured. A factor that the session sets stays if it is larger.
    """
    return _setting(spark, _FACTOR, str(max(FACTOR, float(spark.conf.get(_FACTOR)))))


def sized(run):
    """A function of a session or a DataFrame that runs within :func:`sized_joins`."""

    @wraps(run)
    def sized_run(first, *args, **named):
        with sized_joins(first if isinstance(first, SparkSession) else first.sparkSession):
            return run(first, *args, **named)

    return sized_run


def shuffled_if_large(df: DataFrame, rows: int, how: str = "merge") -> DataFrame:
    """A side of a lazy join, numbers of at most ``rows`` rows; above some MB in memory not to be broadcast."""
    return df if rows <= BROADCAST_NUMBERS else df.hint(how)


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables; a private one only for a local session."""
    root = spark.conf.get(_SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(
            f"{_SETTING} is not set: iterative operators need a shared folder on a cluster"
        )
    root = tempfile.mkdtemp(prefix="archiveloom-")
    spark.conf.set(_SETTING, root)
    return root


class StagingArea:
    """One folder per run of an iterative operator."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{staging_root(spark)}/archiveloom/{name}-{uuid.uuid4().hex}"
        for areas in _open.get():
            areas.append(self)

    def release(self) -> None:
        """Remove the area's tables; results that were read from them must be written first."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def write(self, df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
        """Write ``df`` and read it back, with metrics gathered by the same job."""
        path = f"{self.path}/{name}"
        values: dict = {}
        if metrics:
            watch = Observation(f"{name}-{uuid.uuid4().hex}")
            df = df.observe(watch, *[c.alias(k) for k, c in metrics.items()])
        schema = df.schema
        with _without_leftovers(self.spark):
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        if metrics:
            values = watch.get
        return self.spark.read.schema(schema).parquet(path), values
