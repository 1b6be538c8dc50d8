"""Research-archive analytics on Spark.

The steps of an archive, in order: ``merge_sources`` -> ``clean`` -> ``classify_project_type``
-> ``classify`` -> ``validate`` / ``publish`` -> ``repo_report``.
"""

from archiveloom.operators.clean import clean, fix_repository_ids
from archiveloom.operators.harmonise import Source
from archiveloom.operators.keywords import top_tags
from archiveloom.operators.ledger import stable_ids
from archiveloom.operators.profiles import detect_by_profiles, learn_profiles
from archiveloom.operators.project_type import classify_project_type, list_qda_files, projects_summary
from archiveloom.operators.taxonomy import classify, classify_files, classify_projects
from archiveloom.operators.validate import validate
from archiveloom.operators.vectors import nearest_two
from archiveloom.plans.archive import merge_folders, merge_sources, rebuild
from archiveloom.plans.report import archive_series, repo_report, report_blocks, write_repo_report
from archiveloom.schema import Archive
from archiveloom.sources.landing import as_source, parse_landed
from archiveloom.sources.isolation import opened
from archiveloom.sources.sinks import publish, read_tables, write_csv, write_tables
from archiveloom.sources.snapshots import Snapshots
from archiveloom.sources.worklist import Repository, worklist

__all__ = [
    "Archive", "Repository", "Snapshots", "Source", "archive_series", "as_source", "classify", "classify_files",
    "classify_project_type", "classify_projects", "clean", "detect_by_profiles", "fix_repository_ids", "learn_profiles",
    "list_qda_files", "merge_folders", "merge_sources", "nearest_two", "opened", "parse_landed", "projects_summary", "publish",
    "read_tables", "rebuild", "repo_report", "report_blocks", "stable_ids", "top_tags", "validate", "worklist",
    "write_csv", "write_repo_report", "write_tables",
]
