"""Tables, CSV and text out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archiveloom.operators.harmonise import project_to
from archiveloom.operators.validate import validate
from archiveloom.schema import PUBLISHED_COLUMNS, Archive
from archiveloom.sources.snapshots import Snapshots


class ConstraintViolations(ValueError):
    """The archive breaks a rule of the published schema."""


def published(entity: str, df: DataFrame) -> DataFrame:
    """Exactly the published columns, typed; missing ones are NULL."""
    return df.select(*project_to(df, PUBLISHED_COLUMNS[entity]))


def write_tables(archive: Archive, path: str) -> None:
    """Canonical tables as Parquet, one folder per entity, without any check."""
    for entity, df in archive.tables().items():
        published(entity, df).write.mode("errorifexists").parquet(f"{path}/{entity}")


def read_tables(spark: SparkSession, path: str, entities: list[str] | None = None, version: int | None = None) -> Archive:
    """Tables as published, the latest version unless one is given, or as :func:`write_tables` left them."""
    snapshots = Snapshots(spark, path)
    if snapshots.latest() is None and version is None:
        return Archive(**{e: spark.read.parquet(f"{path}/{e}") for e in entities or list(PUBLISHED_COLUMNS)})
    names = entities or [e for e in PUBLISHED_COLUMNS if e in snapshots.at(version).folders]
    return Archive(**{e: snapshots.read(e, version) for e in names})


def publish(archive: Archive, path: str, apply: bool = False) -> list[tuple[str, int]]:
    """Check the archive and, with ``apply``, make it the next version under ``path``.

    Returns the broken rules (one row per rule at most). Nothing is written unless there is
    none; with ``apply`` a broken rule is an error. All tables change at once: until the last one
    is written readers see the version before, and a failed publish can be repeated.
    """
    broken = [(r["rule"], r["violations"]) for r in validate(archive).collect()]
    if broken and apply:
        raise ConstraintViolations("; ".join(f"{rule}: {n}" for rule, n in broken))
    if apply:
        draft = Snapshots(archive.projects.sparkSession, path).draft()
        draft.folders, draft.schemas = {}, {}  # an entity the archive lacks is not the old one
        for entity, df in archive.tables().items():
            draft.write(entity, published(entity, df))
        draft.commit()
    return broken


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """CSV with a header and doubled quotes, as other readers expect; '' stays apart from NULL."""
    writer = df.write.mode("errorifexists").options(header=True, escape='"', emptyValue='""')
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def write_findings(findings: DataFrame, path: str) -> None:
    """One text folder per repository from (slug, value) rows."""
    findings.select("slug", "value").repartition(F.col("slug")).write.mode("errorifexists").partitionBy(
        "slug"
    ).text(path)


def read_rank_tables(spark: SparkSession, path: str) -> DataFrame:
    """Rank tables written by :func:`write_csv`, partition columns included."""
    schema = "rank bigint, primary_class string, count bigint, slug string, scope string"
    return spark.read.schema(schema).options(header=True, escape='"').csv(path)
