"""One bad source, and one bad file of many, are listed; the rest is read."""

import pytest

from archiveloom.operators.harmonise import harmonise
from archiveloom.sources import isolation
from archiveloom.sources.catalogues import from_paths
from conftest import rows

SCHEMA = "id long, title string"


def test_a_bad_source_is_left_out(spark, tmp_path):
    for name in ("a", "c"):
        spark.createDataFrame([(1, name)], SCHEMA).write.parquet(f"{tmp_path}/{name}")
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "part-0.parquet").write_bytes(b"no parquet at all")
    opening = lambda name: from_paths(spark, {name: {"projects": f"{tmp_path}/{name}"}})[0]
    sources, failures = isolation.opened(spark, ["a", "b", "c", "gone"], opening)
    assert [s.name for s in sources] == ["a", "c"]
    assert sorted(r["source_name"] for r in failures.collect()) == ["b", "gone"]
    assert all(r["reason"] for r in failures.collect())
    assert rows(harmonise(sources)["projects"].select("title")) == [("a",), ("c",)]
    assert isolation.opened(spark, [], opening)[1].count() == 0
    with pytest.raises(ZeroDivisionError):  # an error of the program is no bad source
        isolation.opened(spark, ["a"], lambda name: 1 / 0)


def test_a_bad_file_of_many_is_listed(spark, tmp_path):
    path = tmp_path / "projects"
    spark.range(60).selectExpr("id", "concat('t', id) as title").repartition(6).write.parquet(str(path))
    files = sorted(path.glob("*.parquet"))
    files[0].write_bytes(files[0].read_bytes()[:-20])  # cut off, so without a footer
    middle = files[1].read_bytes()  # its footer is whole, its first page is not
    files[1].write_bytes(middle[:4] + bytes(b ^ 0x5A for b in middle[4:60]) + middle[60:])
    for crc in path.glob(".*.crc"):  # checksums of the local file system would tell earlier
        crc.unlink()
    spark.range(0).selectExpr("id", "'x' as title").write.mode("append").parquet(str(path))
    accounts = isolation.file_accounts(spark, str(path), SCHEMA)
    found = isolation.unreadable(accounts).collect()
    assert sorted(r["path"].split("/")[-1] for r in found) == [files[0].name, files[1].name] and all(r["reason"] for r in found)
    kept = isolation.tolerant(spark, str(path), SCHEMA)
    values = len(kept.collect())  # a bare count would go by the footers
    assert 40 <= values < 50 and values == sum(r["rows"] for r in accounts.collect())
    assert accounts.where("rows = 0 and promised = 0").count() >= 1  # an empty file is no bad one
