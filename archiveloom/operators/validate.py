"""Constraint checks before an archive is published.

Every rule of a table is counted in one pass over it, as conditional aggregates.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archiveloom import dimensions as dim
from archiveloom.operators.clean import _as_rows
from archiveloom.schema import REQUIRED_COLUMNS, Archive

# Table -> ((column, allowed values, description), ...)
ALLOWED_VALUES = {
    "projects": (
        ("download_method", dim.DOWNLOAD_METHODS, "PROJECTS.download_method has a value outside SCRAPING/API-CALL"),
        ("type", dim.PROJECT_TYPES, "PROJECTS.type has a value outside the PROJECT_TYPE enum"),
    ),
    "files": (
        ("status", dim.DOWNLOAD_RESULTS, "FILES.status has a value outside the DOWNLOAD_RESULT enum"),
    ),
    "person_role": (
        ("role", dim.PERSON_ROLES, "PERSON_ROLE.role has a value outside the PERSON_ROLE enum"),
    ),
}


def rules(table: str) -> list[tuple[str, str, Column]]:
    """(column, description, condition) of every rule of a table."""
    found = [
        (c, f"{table.upper()}.{c} is NULL", F.col(c).isNull()) for c in REQUIRED_COLUMNS[table]
    ]
    for c, allowed, description in ALLOWED_VALUES.get(table, ()):
        found.append((c, description, ~F.col(c).isin(*allowed)))
    return found


def constraint_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(rule, violations) for rules that rows break; rules on absent columns are skipped."""
    parts = []
    for table, df in tables.items():
        present = [r for r in rules(table) if r[0] in df.columns]
        counted = df.agg(*[F.count_if(cond).alias(text) for _, text, cond in present])
        parts.append(_as_rows(counted, "rule", "violations"))
    return reduce(DataFrame.union, parts).where("violations > 0")


def duplicate_urls(projects: DataFrame) -> DataFrame:
    """(project_url, n): URLs held by more than one project."""
    return (
        projects.where(F.col("project_url").isNotNull())
        .groupBy("project_url")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )


def orphan_children(children: DataFrame, projects: DataFrame) -> DataFrame:
    """Child rows whose project does not exist."""
    return children.join(
        projects.select(F.col("id").alias("project_id")), "project_id", "left_anti"
    )


def violation_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Everything that blocks publishing, as (rule, violations) rows."""
    duplicates = (
        duplicate_urls(tables["projects"])
        .agg(F.count(F.lit(1)).alias("violations"))
        .select(F.lit("PROJECTS.project_url has duplicate values (would break UNIQUE)").alias("rule"), "violations")
    )
    # counted per parent first, so a parent with very many children is one row
    orphans = [
        orphan_children(df.groupBy("project_id").agg(F.count(F.lit(1)).alias("n")), tables["projects"])
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
        .select(F.lit(f"{name.upper()} without a project").alias("rule"), "violations")
        for name, df in tables.items()
        if name != "projects"
    ]
    parts = [constraint_violations(tables), duplicates, *orphans]
    return reduce(DataFrame.union, parts).where("violations > 0")


def validate(archive: Archive) -> DataFrame:
    return violation_report(archive.tables())
