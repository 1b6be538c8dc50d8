"""Landed records as they arrive.

There are no windows and no state: a record is new when its project URL is not in the
archive yet. Each micro-batch is parsed, compared with an index of the stored URLs (see
:mod:`archiveloom.sources.known_urls`) and appended, projects, children and failures alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from archiveloom.schema import ENTITIES
from archiveloom.sources.known_urls import KnownUrls
from archiveloom.sources.landing import new_projects, without_url
from archiveloom.staging import released

LANDED_SCHEMA = "record_id bigint, json string"

Parser = Callable[[DataFrame], dict[str, DataFrame]]


def landed_stream(spark: SparkSession, path: str) -> DataFrame:
    """Landed Parquet files of (record_id, json), each read once."""
    return spark.readStream.schema(LANDED_SCHEMA).parquet(path)


def append_batch(landed: DataFrame, parse: Parser, path: str, batch_id: int) -> None:
    """Add the projects that are not stored yet, with their children, as batch ``batch_id``.

    Only earlier batches count as stored and the batch's own folders are overwritten, so a
    batch that is run again after a failure leaves the same tables.
    """
    with released():  # the batch's staged tables go with it
        parsed = parse(landed)
        projects = parsed["projects"].withColumn("ord", F.col("record_id"))
        known = _index(landed.sparkSession, path, batch_id, _ddl(projects))
        fresh = new_projects(projects, known.among(projects, batch_id))
        fresh.write.mode("overwrite").parquet(f"{path}/projects/batch={batch_id}")
        added = landed.sparkSession.read.schema(_ddl(projects)).parquet(f"{path}/projects/batch={batch_id}")
        for entity in ENTITIES[1:]:
            children = parsed[entity].join(added.select("record_id"), "record_id", "left_semi")
            children.write.mode("overwrite").parquet(f"{path}/{entity}/batch={batch_id}")
        failures = parsed["failures"].unionByName(without_url(projects))
        failures.write.mode("overwrite").parquet(f"{path}/failures/batch={batch_id}")
        known.add(added, batch_id)


def _index(spark: SparkSession, path: str, batch_id: int, ddl: str) -> KnownUrls:
    """The index of stored URLs, with every batch before this one in it."""
    known = KnownUrls(spark, f"{path}/known_urls")
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/projects")
    names = [s.getPath().getName() for s in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]
    stored = [int(n.removeprefix("batch=")) for n in names if n.startswith("batch=")]
    rows = lambda batch: lambda: spark.read.schema(ddl).parquet(f"{path}/projects/batch={batch}")
    known.catch_up({batch: rows(batch) for batch in stored if batch < batch_id})
    return known


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def append_new(landed: DataFrame, parse: Parser, path: str) -> DataStreamWriter:
    """A writer that adds the unknown projects of each micro-batch to ``path``."""
    with released():
        nothing = parse(landed.sparkSession.createDataFrame([], LANDED_SCHEMA))["projects"]
        # an empty batch makes the table exist before the first one is compared with it
        nothing.withColumn("ord", F.col("record_id")).write.mode("ignore").parquet(f"{path}/projects/batch=-1")
    return landed.writeStream.foreachBatch(
        lambda batch, batch_id: append_batch(batch, parse, path, batch_id)
    )
