"""Catalogues in folders, scanned together where their tables look alike.

One branch of a plan per source makes plans that grow with the number of sources. Here tables are
grouped by signature, the names and types of the columns that the archive takes from them; a
group is one scan of many folders, and the folder a row comes from says which source it belongs to.
A thousand exports of three programs are three scans.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from archiveloom.operators.harmonise import canonical_columns, harmonised_rows, local_bits, rejected_rows
from archiveloom.operators.skew import broadcast_if_small
from archiveloom.schema import ENTITIES

THREADS = 16  # footers read at a time


def signature(table: DataFrame, entity: str) -> tuple[tuple[str, str], ...]:
    """(name in lower case, type) of the columns that are taken from a table, sorted."""
    wanted, found = {"id", "project_id", *canonical_columns(entity)}, {}
    for field in table.schema.fields:
        if field.name.lower() in wanted:
            found.setdefault(field.name.lower(), field.dataType.simpleString())
    return tuple(sorted(found.items()))


def _place(spark: SparkSession, path: str) -> tuple[str, bool]:
    """A path as scans name it, and whether it is a single file."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop)
    return _same_scheme(status.getPath().toUri().toString()), status.isFile()


def _same_scheme(uri: str) -> str:
    return "file:/" + uri.removeprefix("file:").lstrip("/") if uri.startswith("file:") else uri


def _tagged(spark: SparkSession, columns, places: list[tuple[str, int, str]], paths: list[str], single: bool) -> DataFrame:
    """The rows of one group with ``_source`` and ``_rank``."""
    ddl = ", ".join(f"`{name}` {kind}" for name, kind in columns)
    file = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/")
    table = spark.read.schema(ddl).parquet(*paths)
    table = table.withColumn("_place", file if single else F.regexp_replace(file, "/[^/]*$", ""))
    known = broadcast_if_small(spark.createDataFrame(places, "_place string, _rank int, _source string"))
    lost = F.raise_error(F.concat(F.lit("no source has the folder "), F.col("_place"))).cast("int")
    return table.join(known, "_place", "left").withColumn("_rank", F.coalesce("_rank", lost)).drop("_place")


def harmonise_folders(spark: SparkSession, sources: Mapping[str, Mapping[str, str]]) -> dict[str, DataFrame]:
    """As ``harmonise(from_paths(spark, sources))`` for Parquet tables, with one scan per signature.

    ``sources`` maps names to tables to paths; a path is a file, or a folder of files without
    partition folders below. A row whose folder is none of them raises an error. Schemas are read from
    one footer per table, several at a time.
    """
    tables: list[tuple[str, int, str, str]] = []  # entity, rank, source, path
    for rank, (name, paths) in enumerate(sorted(sources.items())):
        own = {e: next((p for t, p in paths.items() if t.lower() == e), None) for e in ENTITIES}
        if own["projects"] is not None:
            tables += [(e, rank, name, path) for e, path in own.items() if path is not None]

    def look(table):
        entity, _, _, path = table
        return signature(spark.read.parquet(path), entity), *_place(spark, path)

    with ThreadPoolExecutor(THREADS) as pool:
        looks = list(pool.map(look, tables))
    groups = defaultdict(list)
    for (entity, rank, name, path), (columns, place, single) in zip(tables, looks):
        names = {c for c, _ in columns}
        if entity == "projects" and "id" not in names:
            raise ValueError(f"source {name}: the projects table has no id column")
        if entity == "projects" or "project_id" in names:
            groups[entity, columns, single].append((place, rank, name, path))

    bits, parts = local_bits(len(sources)), defaultdict(list)
    for (entity, columns, single), members in groups.items():
        table = _tagged(spark, columns, [m[:3] for m in members], [m[3] for m in members], single)
        source: Column = F.col("_source")
        rows = harmonised_rows(table, entity, source, F.col("_rank"), bits)
        if entity == "projects":
            parts["strays"].append(rows.where(F.col("ord").isNull()))
            parts["rejects"].append(rejected_rows(table, source))
            rows = rows.where(F.col("ord").isNotNull())
        parts[entity].append(rows)
    return {e: reduce(DataFrame.unionByName, dfs) for e, dfs in parts.items()}
