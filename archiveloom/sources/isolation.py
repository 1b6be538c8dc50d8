"""Bad sources and bad files do not end a run: they are listed, and the rest is read.

A source whose tables cannot be opened is left out whole. Within a table Spark passes over files it
cannot read; which ones those are follows from accounts: every file that was listed, the rows its footer
promises, and the rows that were read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archiveloom.operators.harmonise import Source

FAILURES = "source_name string, reason string"


def opened(
    spark: SparkSession, names: Iterable[str], open_source: Callable[[str], Source]
) -> tuple[list[Source], DataFrame]:
    """The sources that open, and (source_name, reason) of those that do not.

    Opening resolves paths and schemas; no rows are read.
    """
    sources, failures = [], []
    for name in names:
        try:
            source = open_source(name)
            for table in source.tables.values():
                table.schema  # noqa: B018  resolves the table
            sources.append(source)
        except (PySparkException, Py4JJavaError) as e:
            cause = e.java_exception.getMessage() if isinstance(e, Py4JJavaError) else str(e)
            failures.append((name, (cause or type(e).__name__).split("\n")[0][:500]))
    return sources, spark.createDataFrame(failures, FAILURES)


def tolerant(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table of a known schema without the files that cannot be read."""
    return spark.read.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").schema(schema).parquet(path)


def _promised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, promised, reason): the rows a footer promises, or why there is none."""
    import pyarrow.parquet as pq

    for batch in batches:
        found = []
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            try:
                found.append((path, pq.ParquetFile(pa.BufferReader(content.as_buffer())).metadata.num_rows, None))
            except (pa.ArrowException, OSError) as e:
                found.append((path, None, str(e).split("\n")[0][:200]))
        columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, ["path", "promised", "reason"])


def file_accounts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(path, promised, rows, reason) of every Parquet file of a table.

    ``rows`` could be read in all columns, ``promised`` is what the footer says; a file is whole if the
    two are equal. Where there is no footer, ``promised`` is NULL and ``reason`` says why. The table is
    scanned once for its values and once for its footers; only files that Spark passed over are opened
    as they are.
    """
    table, file = tolerant(spark, path, schema), F.col("_metadata.file_name").alias("file")
    # without a column a scan counts by footers; the hash of all columns makes it read the values
    promised = table.select(file).groupBy("file").agg(F.count(F.lit(1)).alias("promised"))
    values = table.select(file, F.xxhash64(*table.columns).alias("_h"))
    read = values.groupBy("file").agg(F.count("_h").alias("rows"), F.bit_xor("_h").alias("_all")).where("_all is not null")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    listed = listed.withColumn("file", F.substring_index("path", "/", -1))
    known = listed.select("path", "file").join(promised, "file").join(read, "file", "left")
    known = known.select("path", "promised", F.coalesce("rows", F.lit(0)).alias("rows"), F.lit(None).cast("string").alias("reason"))
    silent = listed.join(promised, "file", "left_anti").select("path", "content").mapInArrow(_promised, "path string, promised long, reason string")
    return known.union(silent.select("path", "promised", F.lit(0).cast("bigint").alias("rows"), "reason"))


def unreadable(accounts: DataFrame) -> DataFrame:
    """(path, reason) of files that gave fewer rows than they promise, or have no footer."""
    short = F.col("promised").isNull() | (F.col("rows") < F.col("promised"))
    return accounts.where(short).select("path", F.coalesce("reason", F.lit("rows cannot be read")).alias("reason"))
