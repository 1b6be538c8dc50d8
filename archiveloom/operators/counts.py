"""Counts per repository, type and class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archiveloom import dimensions as dim
from archiveloom.functions.text import label_or, unknown_label


def with_repository_label(df: DataFrame, repositories: DataFrame) -> DataFrame:
    """Adds ``repository``: the label of ``repository_id``, or ``unknown (<id>)``."""
    labels = repositories.select("repository_id", F.col("label").alias("_label"))
    return (
        df.join(labels, "repository_id", "left")
        .withColumn("repository", unknown_label("_label", "repository_id"))
        .drop("_label")
    )


def class_label(column: str = "primary_class") -> Column:
    return label_or(column, dim.UNCLASSIFIED)


def report_type_label(column: str = "type") -> Column:
    """Type label of the per-repository reports; anything unknown is no project."""
    out = F.lit(dim.NO_PROJECT_LABEL)
    for value, label in reversed(dim.TYPE_LABELS):
        out = F.when(F.col(column) == value, F.lit(label)).otherwise(out)
    return out


def count_by_repository(projects: DataFrame, repositories: DataFrame) -> DataFrame:
    """(repository, n, tie): counted per id, then per label, since labels may collide."""
    per_id = projects.groupBy("repository_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        with_repository_label(per_id, repositories)
        .groupBy("repository")
        .agg(F.sum("n").alias("n"), F.min("repository_id").alias("tie"))
    )


def count_by_type(projects: DataFrame) -> DataFrame:
    """(label, n): a missing type is UNCLASSIFIED, an unknown one keeps its own name."""
    return projects.groupBy(label_or("type", dim.UNCLASSIFIED).alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )


def count_by_class(projects: DataFrame) -> DataFrame:
    """(column_name, label, n) for the primary and the secondary class, in one pass."""
    both = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), class_label(c).alias("label"))
            for c in ("primary_class", "secondary_class")
        ]
    )
    return projects.select(F.inline(both)).groupBy("column_name", "label").agg(
        F.count(F.lit(1)).alias("n")
    )


def class_cube(projects: DataFrame, repositories: DataFrame) -> DataFrame:
    """(repository, type, primary_class, n, first_id): the base of every repository report.

    The only pass over the projects; its result has at most one row per repository, type
    and class, and all coarser counts are sums over it. ``first_id`` is the smallest project
    id, which orders equal counts.
    """
    per_id = projects.groupBy(
        "repository_id", "type", class_label().alias("primary_class")
    ).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
    return (
        with_repository_label(per_id, repositories)
        .groupBy("repository", "type", "primary_class")
        .agg(F.sum("n").alias("n"), F.min("first_id").alias("first_id"))
    )


def repo_class_counts(cube: DataFrame) -> DataFrame:
    return cube.groupBy("repository", "primary_class").agg(
        F.sum("n").alias("n"), F.min("first_id").alias("first_id")
    )


def repo_type_counts(cube: DataFrame) -> DataFrame:
    """(repository, type_label, n)."""
    return cube.groupBy("repository", report_type_label().alias("type_label")).agg(
        F.sum("n").alias("n")
    )


def repo_type_pivot(cube: DataFrame) -> DataFrame:
    """One row per repository with the four type counts, zero-filled."""
    return cube.groupBy("repository").agg(
        F.sum("n").alias("total"),
        *[
            F.coalesce(F.sum(F.when(report_type_label() == label, F.col("n"))), F.lit(0))
            .cast("bigint")
            .alias(column)
            for column, (_, label) in zip(("qda", "qd", "other", "no_project"), dim.TYPE_LABELS)
        ],
    )


def repo_rollup(cube: DataFrame) -> DataFrame:
    """Counts by (repository, class), (repository, type) and (repository, type, class).

    ``grouping`` names the level, because NULL is a real type and so cannot mark one.
    """
    levels = cube.groupingSets(
        [
            [F.col("repository"), F.col("primary_class")],
            [F.col("repository"), F.col("type")],
            [F.col("repository"), F.col("type"), F.col("primary_class")],
        ],
        "repository", "type", "primary_class",
    ).agg(
        F.grouping("type").alias("no_type"),
        F.grouping("primary_class").alias("no_class"),
        F.sum("n").alias("n"),
    )
    level = (
        F.when(F.col("no_type") == 1, F.lit("class"))
        .when(F.col("no_class") == 1, F.lit("type"))
        .otherwise(F.lit("type and class"))
    )
    return levels.select("repository", level.alias("grouping"), "type", "primary_class", "n")


def repo_file_class_counts(
    projects: DataFrame, files: DataFrame, repositories: DataFrame
) -> DataFrame:
    """(repository, primary_class, n, first_id) over classified files.

    Files are counted per project and class before they meet the projects, so a project
    with very many files enters the join as a few rows.
    """
    per_project = (
        files.where(F.col("primary_class").isNotNull())
        .groupBy("project_id", "primary_class")
        .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
    )
    parents = projects.select(F.col("id").alias("project_id"), "repository_id")
    per_id = (
        per_project.join(parents, "project_id")
        .groupBy("repository_id", "primary_class")
        .agg(F.sum("n").alias("n"), F.min("first_id").alias("first_id"))
    )
    return (
        with_repository_label(per_id, repositories)
        .groupBy("repository", "primary_class")
        .agg(F.sum("n").alias("n"), F.min("first_id").alias("first_id"))
    )
