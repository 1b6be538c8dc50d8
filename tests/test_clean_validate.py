import pytest
from pyspark.sql import functions as F

from archiveloom import dimensions as dim
from archiveloom.operators import clean as cl
from archiveloom.operators import validate as vd
from archiveloom.operators.project_type import classify_project_type, type_tally
from archiveloom.schema import PUBLISHED_COLUMNS, Archive
from archiveloom.sources import sinks
from conftest import rows


def projects(spark, data):
    """Projects from dicts; what a dict leaves out gets a valid value."""
    valid = {
        "query_string": None, "repository_id": 1, "repository_url": "r", "version": None, "type": None,
        "title": "t", "description": "d", "language": None, "doi": None, "download_date": "2024-01-01 00:00:00",
        "download_repository_folder": "f", "download_project_folder": "p", "download_method": "API-CALL",
    }
    schema = "id long, project_url string, repository_id long, " + ", ".join(
        f"{c} string" for c in valid if c != "repository_id"
    )
    names = ["id", "project_url", "repository_id", *[c for c in valid if c != "repository_id"]]
    full = [{**valid, "project_url": f"u{d['id']}", **d} for d in data]
    return spark.createDataFrame([tuple(d[n] for n in names) for d in full], schema)


def files(spark, data):
    return spark.createDataFrame(
        data, "id long, project_id long, file_name string, file_type string, status string"
    )


def test_cleaning_rules(spark):
    df = projects(spark, [
        {"id": 1, "project_url": "", "doi": "d", "download_method": "API"},
        {"id": 2, "project_url": None, "doi": "d", "download_method": "x"},
        {"id": 3, "project_url": "", "doi": "", "download_method": None, "download_date": None},
        {"id": 4, "download_method": "SCRAPING"},
    ])
    got = rows(cl.clean_projects(df).select("id", "project_url", "download_method", "download_date", "download_date_imputed"))
    assert got == [
        (1, "d", "API-CALL", "2024-01-01 00:00:00", False),
        (2, None, "SCRAPING", "2024-01-01 00:00:00", False),
        (3, "", None, dim.IMPUTED_DOWNLOAD_DATE, True),
        (4, "u4", "SCRAPING", "2024-01-01 00:00:00", False),
    ]
    people = spark.createDataFrame([("uploader",), ("Uploader",), (None,)], "role string")
    assert rows(cl.clean_person_role(people)) == [("UPLOADER",), ("Uploader",), (None,)]
    audit = dict(rows(cl.cleaning_audit(df, files(spark, [(1, 1, "a", "b", "odd"), (2, 1, "a", "b", None)]), people)))
    assert audit == {
        "project_url from doi": 1, "download_method to API-CALL": 1, "download_method to SCRAPING": 1,
        "download_date imputed": 1, "status to FAILED_LOGIN_REQUIRED": 1, "role to UPLOADER": 1,
    }


def test_repository_ids_and_cascade(spark):
    df = projects(spark, [{"id": 1, "repository_id": 3}, {"id": 2, "repository_id": 99}, {"id": 3, "repository_id": None}])
    dims = dim.repositories_table(spark)
    assert rows(cl.fix_repository_ids(df, dims).select("id", "repository_id")) == [(1, 3), (2, 17), (3, 17)]
    assert rows(cl.invalid_repository_ids(df, dims).select("id", "repository_id")) == [(2, 99), (3, None)]
    archive = Archive(df, files=files(spark, [(1, 1, "a", "", ""), (2, 2, "b", "", "")]))
    kept = cl.delete_projects(archive, spark.createDataFrame([(2,)], "id long"))
    assert rows(kept.projects.select("id")) == [(1,), (3,)] and rows(kept.files.select("id")) == [(1,)]


def test_ignored_types_and_fetch_status(spark):
    df = spark.createDataFrame([("m2ts",), ("fits",), ("pdf",), ("zip",), (None,)], "file_type string")
    assert rows(cl.drop_ignored_types(df)) == [("pdf",), (None,)]
    assert rows(cl.drop_ignored_types(df, strict_compat=True)) == [("fits",), ("m2ts",), ("pdf",), (None,)]
    log = spark.createDataFrame(
        [(200, "a"), (302, "a"), (401, "a"), (403, "a"), (413, "a"), (404, "a"), (None, "a"), (200, ""), (200, None)],
        "s int, n string",
    )
    got = [r[0] for r in log.select(cl.fetch_status(F.col("s"), F.col("n"))).collect()]
    login, big, dead = "FAILED_LOGIN_REQUIRED", "FAILED_TOO_LARGE", "FAILED_SERVER_UNRESPONSIVE"
    assert got == ["SUCCEEDED", "SUCCEEDED", login, login, big, dead, dead, dead, dead]


def test_publish_gate(spark, tmp_path):
    good = Archive(
        projects(spark, [{"id": 1}, {"id": 2}]),
        files=files(spark, [(1, 1, "a.pdf", "pdf", "SUCCEEDED")]),
    )
    assert sinks.publish(good, f"{tmp_path}/dry") == [] and not (tmp_path / "dry").exists()
    assert sinks.publish(good, f"{tmp_path}/out", apply=True) == []
    back = sinks.read_tables(spark, f"{tmp_path}/out", ["projects", "files"])
    assert back.projects.columns == list(PUBLISHED_COLUMNS["projects"])
    assert rows(back.files.select("id", "primary_class")) == [(1, None)]

    bad = Archive(
        projects(spark, [{"id": 1, "title": None, "type": "odd"}, {"id": 2, "project_url": "u1"}]),
        files=files(spark, [(1, 9, "a", None, "odd")]),
    )
    found = dict(sinks.publish(bad, f"{tmp_path}/bad"))
    assert found == {
        "PROJECTS.title is NULL": 1, "PROJECTS.type has a value outside the PROJECT_TYPE enum": 1,
        "PROJECTS.project_url has duplicate values (would break UNIQUE)": 1, "FILES.file_type is NULL": 1,
        "FILES.status has a value outside the DOWNLOAD_RESULT enum": 1, "FILES without a project": 1,
    }
    with pytest.raises(sinks.ConstraintViolations):
        sinks.publish(bad, f"{tmp_path}/bad", apply=True)
    assert not (tmp_path / "bad").exists()


def test_rules_on_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([(1, None)], "id long, title string")
    assert rows(vd.constraint_violations({"projects": df})) == [("PROJECTS.title is NULL", 1)]


def test_project_types(spark):
    df = projects(spark, [{"id": i} for i in range(1, 7)])
    f = files(spark, [
        (1, 1, "a.qdpx", None, ""), (2, 1, "b.pdf", None, ""), (3, 2, "b.MP3", "", ""), (4, 3, "x", "unknown", ""),
        (5, 4, "Thumbs.db", "pdf", ""), (6, 4, "a.tmp", "", ""), (7, 4, None, None, ""), (8, 5, "n", "..QDA ", ""),
    ])
    typed = classify_project_type(df, f)
    assert rows(typed.select("id", "type")) == [
        (1, "QDA_PROJECT"), (2, "QD_PROJECT"), (3, "OTHER_PROJECT"), (4, "NOT_A_PROJECT"), (5, "QDA_PROJECT"), (6, "NOT_A_PROJECT"),
    ]
    tally = dict(rows(type_tally(typed.where("id > 3"), dim.type_labels_table(spark))))
    assert tally == {"QDA_PROJECT": 1, "QD_PROJECT": 0, "OTHER_PROJECT": 0, "NOT_A_PROJECT": 2}


def test_csv_keeps_empty_and_missing_apart(spark, tmp_path):
    from archiveloom.sources.catalogues import from_paths

    df = spark.createDataFrame([(1, ""), (2, None), (3, 'a "b", c')], "id long, title string")
    sinks.write_csv(df, f"{tmp_path}/csv")
    (source,) = from_paths(spark, {"s": {"projects": f"{tmp_path}/csv"}}, "csv")
    assert rows(source.tables["projects"]) == [("1", ""), ("2", None), ("3", 'a "b", c')]
    import csv

    lines = [r.value for r in spark.read.text(f"{tmp_path}/csv").collect()]
    assert ["3", 'a "b", c'] in list(csv.reader(lines))
