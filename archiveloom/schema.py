"""Canonical entities of the archive.

One parent (``projects``) and four children keyed by ``project_id``. The column lists give
the order in which harmonised and published tables carry their columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

# Columns a catalogue may contribute to the merge, with the type they are cast to.
PROJECT_SOURCE_COLUMNS = {
    "query_string": "string",
    "repository_id": "bigint",
    "repository_url": "string",
    "project_url": "string",
    "version": "string",
    "title": "string",
    "description": "string",
    "language": "string",
    "doi": "string",
    "upload_date": "string",
    "download_date": "string",
    "download_repository_folder": "string",
    "download_project_folder": "string",
    "download_version_folder": "string",
    "download_method": "string",
}

CHILD_COLUMNS = {
    "files": {"file_name": "string", "file_type": "string", "status": "string"},
    "keywords": {"keyword": "string"},
    "person_role": {"name": "string", "role": "string"},
    "licenses": {"license": "string"},
}

ENTITIES = ("projects", *CHILD_COLUMNS)

# Published layout: what the classification adds sits next to the harvested columns.
PUBLISHED_COLUMNS = {
    "projects": {
        "id": "bigint",
        "query_string": "string",
        "repository_id": "bigint",
        "repository_url": "string",
        "project_url": "string",
        "version": "string",
        "type": "string",
        "title": "string",
        "description": "string",
        "language": "string",
        "doi": "string",
        "upload_date": "date",
        "download_date": "timestamp",
        "download_repository_folder": "string",
        "download_project_folder": "string",
        "download_version_folder": "string",
        "download_method": "string",
        "primary_class": "string",
        "secondary_class": "string",
        "tags": "array<string>",
    },
    "files": {
        "id": "bigint",
        "project_id": "bigint",
        "file_name": "string",
        "file_type": "string",
        "status": "string",
        "primary_class": "string",
        "secondary_class": "string",
    },
    "keywords": {"id": "bigint", "project_id": "bigint", "keyword": "string"},
    "person_role": {"id": "bigint", "project_id": "bigint", "name": "string", "role": "string"},
    "licenses": {"id": "bigint", "project_id": "bigint", "license": "string"},
}

# Columns that must be filled at publish time.
REQUIRED_COLUMNS = {
    "projects": (
        "repository_id",
        "repository_url",
        "project_url",
        "title",
        "description",
        "download_date",
        "download_repository_folder",
        "download_project_folder",
        "download_method",
    ),
    "files": ("file_name", "file_type", "status"),
    "keywords": ("keyword",),
    "person_role": ("name", "role"),
    "licenses": ("license",),
}


@dataclass(frozen=True)
class Archive:
    """The five entities as DataFrames. ``extras`` carries audit tables of the run."""

    projects: DataFrame
    files: DataFrame | None = None
    keywords: DataFrame | None = None
    person_role: DataFrame | None = None
    licenses: DataFrame | None = None
    extras: dict[str, DataFrame] = field(default_factory=dict)

    def tables(self) -> dict[str, DataFrame]:
        """Entities that are present, parent first."""
        return {e: getattr(self, e) for e in ENTITIES if getattr(self, e) is not None}

    def with_tables(self, **tables: DataFrame) -> "Archive":
        return replace(self, **tables)
