"""Project typing from file extensions, and what follows from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archiveloom import dimensions as dim
from archiveloom.functions.files import (
    file_extension,
    is_content,
    is_junk_name,
    project_type_of,
    stem_tokens,
    type_priority,
)


def per_project_files(files: DataFrame) -> DataFrame:
    """(project_id, n_files, priority): all a project's files say about it, in one aggregate.

    The extension set is never built: its priority test is a maximum, which is combined on
    the map side, so a project with a third of all files costs one row per map task.
    """
    seen = files.select(
        "project_id",
        file_extension("file_type", "file_name").alias("ext"),
        is_junk_name("file_name").alias("junk"),
    )
    priority = F.when(~F.col("junk") & is_content(F.col("ext")), type_priority(F.col("ext")))
    return seen.groupBy("project_id").agg(
        F.count(F.lit(1)).alias("n_files"), F.max(priority).alias("priority")
    )


def classify_project_type(projects: DataFrame, files: DataFrame) -> DataFrame:
    """Projects with their ``type`` recomputed; a project without content files is none."""
    found = per_project_files(files).select(F.col("project_id").alias("id"), "priority")
    return (
        projects.drop("type")
        .join(found, "id", "left")
        .withColumn("type", project_type_of(F.col("priority")))
        .drop("priority")
    )


def type_tally(projects: DataFrame, type_labels: DataFrame) -> DataFrame:
    """(type, n) over the four types, zero-filled."""
    counts = projects.groupBy("type").agg(F.count(F.lit(1)).alias("n"))
    return (
        type_labels.select("type")
        .join(F.broadcast(counts.where(F.col("type").isin(*dim.PROJECT_TYPES))), "type", "left")
        .select("type", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
    )


def list_qda_files(files: DataFrame) -> DataFrame:
    """Files of analysis tools; housekeeping names are not looked at here."""
    return files.where(file_extension("file_type", "file_name").isin(*dim.QDA_EXTENSIONS))


def projects_summary(projects: DataFrame, files: DataFrame) -> DataFrame:
    """One row per project with its file count; files are counted before the join."""
    counts = files.groupBy("project_id").agg(F.count(F.lit(1)).alias("n_files"))
    return projects.join(
        counts.withColumnRenamed("project_id", "id"), "id", "left"
    ).select(
        "id", "repository_id", "type", "title", "primary_class", "secondary_class",
        F.coalesce("n_files", F.lit(0)).cast("bigint").alias("n_files"),
    )


def typed_summary(projects: DataFrame, files: DataFrame) -> DataFrame:
    """Type and file count of every project from a single aggregate over the files."""
    found = per_project_files(files).withColumnRenamed("project_id", "id")
    return projects.drop("type").join(found, "id", "left").select(
        "id", "repository_id", project_type_of(F.col("priority")).alias("type"), "title",
        "primary_class", "secondary_class",
        F.coalesce("n_files", F.lit(0)).cast("bigint").alias("n_files"),
    )


def file_candidates(files: DataFrame, projects: DataFrame) -> DataFrame:
    """Primary data files of QDA and QD projects, with name tokens and the project's classes.

    ``by_name`` says whether the name carries enough words to be classified itself. File
    filters run before the join; adaptive execution splits the join of a project with many files.
    """
    wanted = files.where(
        ~is_junk_name("file_name")
        & file_extension("file_type", "file_name").isin(*dim.PRIMARY_DATA_EXTENSIONS)
    ).select(F.col("id").alias("file_id"), "project_id", "file_name")
    parents = projects.where(F.col("type").isin("QDA_PROJECT", "QD_PROJECT")).select(
        F.col("id").alias("project_id"),
        F.col("primary_class").alias("project_primary"),
        F.col("secondary_class").alias("project_secondary"),
    )
    joined = wanted.join(parents, "project_id")
    return joined.withColumn("tokens", stem_tokens("file_name")).select(
        "file_id", "project_id",
        F.array_join("tokens", " ").alias("text"),
        (F.coalesce(F.size("tokens"), F.lit(0)) >= 2).alias("by_name"),
        "project_primary", "project_secondary",
    )
