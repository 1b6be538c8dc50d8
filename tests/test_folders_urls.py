"""Folders scanned by signature, and the index of stored URLs."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from archiveloom.operators.harmonise import harmonise
from archiveloom.plans.archive import merge_folders, merge_sources
from archiveloom.sources import landing as ld
from archiveloom.sources.catalogues import from_paths
from archiveloom.sources.folders import harmonise_folders
from archiveloom.sources.known_urls import KnownUrls
from conftest import rows


def lay(root, n):
    """Catalogues of three kinds: other types, other columns in other case and order, and a single file."""
    found = {}
    for i in range(n):
        name, kind = f"s {i:04d}%", i % 3
        folder = root / name
        (folder / "projects").mkdir(parents=True)
        if kind == 0:
            projects = pa.table({"id": [1, 2], "title": [f"T{i}", "same"], "project_url": [f"u{i}", None], "junk": [i, i]})
            kids = pa.table({"id": [1], "project_id": [2], "keyword": [f"k{i}"]})
        elif kind == 1:
            projects = pa.table({"TITLE": ["same", f"T{i}"], "Project_URL": [None, f"u{i - 1}"], "ID": ["1", "x2"], "repository_id": ["4", "four"]})
            kids = pa.table({"Project_Id": ["x2", "9"], "KEYWORD": [f"k{i - 1}", "orphan"], "id": ["1", "2"]})
        else:
            projects, kids = pa.table({"id": [None, 7], "doi": ["d", f"d{i}"]}, schema=pa.schema([("id", pa.int64()), ("doi", pa.string())])), pa.table({"id": [1], "keyword": ["no parent"]})
        single = kind == 2
        paths = {"Projects": folder / "projects" / "part-0.parquet", "keywords": folder / "kids.parquet"}
        pq.write_table(projects, paths["Projects"])
        pq.write_table(kids, paths["keywords"])
        found[name] = {"Projects": str(paths["Projects"] if single else folder / "projects"), "keywords": str(paths["keywords"])}
    found["no projects"] = {"keywords": found["s 0000%"]["keywords"]}
    return found


def test_folders_are_scanned_by_kind(spark, tmp_path):
    paths = lay(tmp_path, 9)
    ours, theirs = harmonise_folders(spark, paths), harmonise(from_paths(spark, paths))
    assert ours.keys() == theirs.keys()
    for entity, df in theirs.items():
        assert sorted(ours[entity].columns) == sorted(df.columns)
        assert rows(ours[entity].select(*df.columns)) == rows(df), entity
    merged, expected = merge_folders(spark, paths), merge_sources(from_paths(spark, paths))
    assert rows(merged.projects.select("id", "title", "project_url", "doi")) == rows(expected.projects.select("id", "title", "project_url", "doi"))
    assert rows(merged.keywords) == rows(expected.keywords)
    lame = tmp_path / "lame.parquet"
    pq.write_table(pa.table({"title": ["t"]}), lame)
    with pytest.raises(ValueError, match="no id column"):
        harmonise_folders(spark, {"lame": {"projects": str(lame)}})
    below = tmp_path / "below" / "part=1"
    below.mkdir(parents=True)
    pq.write_table(pa.table({"id": [1], "title": ["t"]}), below / "x.parquet")
    with pytest.raises(Exception, match="no source has the folder"):
        harmonise_folders(spark, {"below": {"projects": str(below.parent)}})["projects"].collect()


def test_the_plan_does_not_grow_with_sources(spark, tmp_path):
    plans = {}
    for n in (30, 300):
        found = harmonise_folders(spark, lay(tmp_path / str(n), n))["projects"]
        plans[n] = found._jdf.queryExecution().optimizedPlan().toString().count("Relation")
        # all but the rows without an id, and those whose id gives no place
        assert found.count() == n // 3 * 4
    assert plans[30] == plans[300] < 10


def test_resource_lists(spark):
    lists = [
        (1, '{"resources":[{"resource_id":5,"filename":"a/b*.csv","title":"T"},{"id":"6","filename":"","title":"Code: book"},{"resource_id":"","id":7}]}'),
        (2, '{"resources":[]}'), (3, "no json"), (4, None),
    ]
    found = ld.nada_resources(spark.createDataFrame(lists, "record_id int, json string"), "s")
    assert rows(found.select("seq", "file_ref", "download_url", "file_name", "file_type")) == [
        (0, "5", "s/catalog/download/5", "ab.csv", "csv"), (1, "6", "s/catalog/download/6", "Code book.pdf", "pdf"),
        (2, "7", "s/catalog/download/7", "file_7.pdf", "pdf"),
    ]
    assert found.where("record_id > 1").count() == 0


def test_known_urls(spark, tmp_path):
    index = KnownUrls(spark, str(tmp_path / "index"), buckets=64)
    urls = lambda first, n: spark.range(first, first + n).select(F.concat(F.lit("https://a/"), F.col("id").cast("string")).alias("project_url"))
    assert index.among(urls(0, 5), 9).count() == 0 and index.batches() == set()
    nothing = urls(0, 0)
    index.add(nothing, -1)
    assert index.among(urls(0, 5), 9).count() == 0
    index.add(urls(0, 40_000).union(urls(0, 10)).union(spark.sql("select null")), 0)
    index.add(urls(40_000, 50), 1)
    index.add(urls(39_990, 100), 1)  # a batch that is run again
    assert index.batches() == {-1, 0, 1}
    asked = urls(39_980, 400).union(spark.sql("select null"))
    assert {r[0] for r in index.among(asked, 2).collect()} == {f"https://a/{i}" for i in range(39_980, 40_090)}
    assert {r[0] for r in index.among(asked, 1).collect()} == {f"https://a/{i}" for i in range(39_980, 40_000)}
    assert index.among(asked, 0).count() == 0 and index.among(nothing, 2).count() == 0
    # what the filters exclude is not read: about one new URL in twenty reaches a bucket
    words = spark.read.parquet(f"{index.path}/words").count()
    assert words < 40_150 / 4
    fresh = urls(1_000_000, 2000)
    assert 0 < index.possible(fresh, 2).count() < 2000 * 0.12 and index.among(fresh, 2).count() == 0
    one = index.among(urls(7, 1).union(urls(1_000_000, 5)), 2)
    scan = [line for line in one._jdf.queryExecution().toString().split("\n") if "FileScan" in line and "index/urls" in line]
    assert one.count() == 1 and scan and all("PartitionFilters" in line and "bucket" in line.split("PartitionFilters")[1] for line in scan)
    # batches that are stored but not in the index, because a run ended in between, are caught up
    index.catch_up({1: lambda: 1 / 0, 5: lambda: urls(2_000_000, 3)})
    assert index.among(urls(2_000_000, 9), 6).count() == 3 and index.among(urls(2_000_000, 9), 5).count() == 0
