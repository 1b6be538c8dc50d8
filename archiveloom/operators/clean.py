"""Cleaning rules, each a column expression, with an audit of what they change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archiveloom import dimensions as dim
from archiveloom.operators.skew import broadcast_if_small
from archiveloom.schema import Archive


def cleaned_project_url() -> Column:
    """An empty URL (not a missing one) takes the DOI."""
    return F.when(_url_from_doi(), F.col("doi")).otherwise(F.col("project_url"))


def _url_from_doi() -> Column:
    return (F.col("project_url") == "") & (F.col("doi") != "")


def cleaned_download_method() -> Column:
    """API spellings to API-CALL, any other unknown value to SCRAPING, NULL stays."""
    c = F.col("download_method")
    return (
        F.when(c.isin(*dim.API_METHOD_SPELLINGS), F.lit("API-CALL"))
        .when(~c.isin(*dim.DOWNLOAD_METHODS), F.lit("SCRAPING"))
        .otherwise(c)
    )


def cleaned_status() -> Column:
    c = F.col("status")
    return F.when(~c.isin(*dim.DOWNLOAD_RESULTS), F.lit("FAILED_LOGIN_REQUIRED")).otherwise(c)


def cleaned_role() -> Column:
    c = F.col("role")
    return F.when(c == "uploader", F.lit("UPLOADER")).otherwise(c)


def imputed_download_date(value: str = dim.IMPUTED_DOWNLOAD_DATE) -> Column:
    date = F.col("download_date").cast("string")
    return F.coalesce(date, F.lit(value))


def clean_projects(projects: DataFrame) -> DataFrame:
    """All project rules in one projection; ``download_date_imputed`` marks filled dates."""
    return projects.withColumns(
        {
            "project_url": cleaned_project_url(),
            "download_method": cleaned_download_method(),
            "download_date": imputed_download_date(),
            "download_date_imputed": F.col("download_date").isNull(),
        }
    )


def clean_files(files: DataFrame) -> DataFrame:
    return files.withColumn("status", cleaned_status())


def clean_person_role(people: DataFrame) -> DataFrame:
    return people.withColumn("role", cleaned_role())


def delete_projects(archive: Archive, doomed: DataFrame, column: str = "id") -> Archive:
    """Remove the listed projects and every child row of theirs.

    ``doomed`` is a one-column table of project ids of any size; Spark broadcasts it only
    when its statistics say it is small.
    """
    ids = doomed.select(F.col(column).alias("_doomed"))
    kept = {}
    for entity, df in archive.tables().items():
        key = "id" if entity == "projects" else "project_id"
        kept[entity] = df.join(ids, df[key] == ids["_doomed"], "left_anti")
    return archive.with_tables(**kept)


def cleaning_audit(projects: DataFrame, files: DataFrame, people: DataFrame) -> DataFrame:
    """(rule, changed): rows each rule is about to change, one pass per table."""
    method = F.col("download_method")
    spelled = method.isin(*dim.API_METHOD_SPELLINGS)
    of_projects = projects.agg(
        F.count_if(_url_from_doi()).alias("project_url from doi"),
        F.count_if(spelled).alias("download_method to API-CALL"),
        F.count_if(~spelled & ~method.isin(*dim.DOWNLOAD_METHODS)).alias("download_method to SCRAPING"),
        F.count_if(F.col("download_date").isNull()).alias("download_date imputed"),
    )
    of_files = files.agg(
        F.count_if(~F.col("status").isin(*dim.DOWNLOAD_RESULTS)).alias("status to FAILED_LOGIN_REQUIRED")
    )
    of_people = people.agg(F.count_if(F.col("role") == "uploader").alias("role to UPLOADER"))
    return (
        _as_rows(of_projects, "rule", "changed")
        .union(_as_rows(of_files, "rule", "changed"))
        .union(_as_rows(of_people, "rule", "changed"))
    )


def _as_rows(one_row: DataFrame, name: str, value: str) -> DataFrame:
    """A one-row table of counters as (name, value) rows."""
    pairs = [F.struct(F.lit(c).alias(name), F.col(f"`{c}`").alias(value)) for c in one_row.columns]
    return one_row.select(F.inline(F.array(*pairs)))


def fix_repository_ids(
    projects: DataFrame, repositories: DataFrame, fallback: int = dim.FALLBACK_REPOSITORY_ID
) -> DataFrame:
    """Unknown or missing repository ids become ``fallback``."""
    known = broadcast_if_small(repositories.select(F.col("repository_id").alias("_known")).distinct())
    return (
        projects.join(known, projects["repository_id"] == known["_known"], "left")
        .withColumn("repository_id", F.coalesce("_known", F.lit(fallback).cast("bigint")))
        .drop("_known")
    )


def invalid_repository_ids(projects: DataFrame, repositories: DataFrame) -> DataFrame:
    """(id, repository_id) of the projects :func:`fix_repository_ids` changes."""
    known = broadcast_if_small(repositories.select("repository_id"))
    return projects.select("id", "repository_id").join(known, "repository_id", "left_anti")


def drop_ignored_types(files: DataFrame, column: str = "file_type", strict_compat: bool = False) -> DataFrame:
    """Leave out media, archive and binary files.

    ``strict_compat`` keeps the two types whose list entries are fused in older runs. A
    file without a type is kept.
    """
    types = [
        t for t in dim.IGNORED_FILE_TYPES if not (strict_compat and t in dim.FUSED_IGNORED_TYPES)
    ]
    c = F.col(column)
    return files.where(c.isNull() | ~c.isin(*types))


def fetch_status(http_status: Column, name: Column) -> Column:
    """Outcome of a file download from its HTTP status (NULL: no answer) and file name."""
    return (
        F.when(F.coalesce(name, F.lit("")) == "", F.lit("FAILED_SERVER_UNRESPONSIVE"))
        .when(http_status.between(200, 399), F.lit("SUCCEEDED"))
        .when(http_status.isin(401, 403), F.lit("FAILED_LOGIN_REQUIRED"))
        .when(http_status == 413, F.lit("FAILED_TOO_LARGE"))
        .otherwise(F.lit("FAILED_SERVER_UNRESPONSIVE"))
    )


def clean(archive: Archive, doomed: DataFrame | None = None) -> Archive:
    """Every cleaning rule over an archive; deletes the ``doomed`` project ids first."""
    if doomed is not None:
        archive = delete_projects(archive, doomed, doomed.columns[0])
    tables = {"projects": clean_projects(archive.projects)}
    if archive.files is not None:
        tables["files"] = clean_files(archive.files)
    if archive.person_role is not None:
        tables["person_role"] = clean_person_role(archive.person_role)
    return archive.with_tables(**tables)
