"""Where catalogues come from: Spark databases or table paths."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from archiveloom.operators.harmonise import Source


def from_databases(spark: SparkSession, databases: list[str]) -> list[Source]:
    """One source per Spark database, with all of its tables."""
    found = []
    for db in databases:
        names = [t.name for t in spark.catalog.listTables(db) if not t.isTemporary]
        found.append(Source(db, {n: spark.table(f"`{db}`.`{n}`") for n in names}))
    return found


def from_paths(
    spark: SparkSession, sources: Mapping[str, Mapping[str, str]], fmt: str = "parquet", **options: str
) -> list[Source]:
    """One source per name, with tables at paths.

    CSV keeps the difference between an empty and a missing value: an unquoted empty field
    is NULL and a quoted one is ''.
    """
    if fmt == "csv":
        options = {"header": "true", "escape": '"', "nullValue": "\u0000", "emptyValue": "", **options}
    return [
        Source(name, {t: spark.read.format(fmt).options(**options).load(p) for t, p in tables.items()})
        for name, tables in sources.items()
    ]
