"""Joins that must not fill the driver's memory, and keywords that are moved and sorted less."""

import pytest
from pyspark.sql import functions as F

from archiveloom import staging as st
from archiveloom.functions.text import WHITESPACE, text_key, word_key
from archiveloom.operators import increment, merge, skew
from archiveloom.operators.harmonise import Source
from archiveloom.plans import archive
from archiveloom.sources.snapshots import Draft
from archiveloom.staging import StagingArea

KEYS = "ord long, project_url string, doi string, title string, repository_id long"


@pytest.fixture()
def factors(monkeypatch):
    """The factors by which tables count for broadcasts when something is written."""
    seen = []
    for kind in (StagingArea, Draft):
        def write(self, *a, _kind=kind, _write=kind.write, **named):
            spark = self.spark if _kind is StagingArea else self.snapshots.spark
            seen.append(float(spark.conf.get(st._FACTOR)))
            return _write(self, *a, **named)

        monkeypatch.setattr(kind, "write", write)
    return seen


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def keys(spark, places):
    records = [(i, f"u/{i // 3}", f"d{(i + 1) // 3}", None, None) for i in places]
    return merge.match_keys(spark.createDataFrame(records, KEYS))


def test_staged_tables_are_broadcast_by_their_memory(spark):
    staged, _ = StagingArea(spark, "test").write(spark.range(1_000_000), "t")
    assert sum(len(open(f.removeprefix("file:"), "rb").read()) for f in staged.inputFiles()) < 10 << 20  # below the threshold ...
    other = spark.read.parquet(staged.inputFiles()[0].rsplit("/", 1)[0])
    with st.sized_joins(spark):
        assert "BroadcastHashJoin" not in plan(staged.join(other, "id", "left_semi"))  # ... yet too large
    assert float(spark.conf.get(st._FACTOR)) == 1
    small, large = (st.shuffled_if_large(spark.range(9), n) for n in (9, 10**6))
    assert "BroadcastHashJoin" in plan(spark.range(50).join(small, "id")) and "SortMergeJoin" in plan(spark.range(50).join(large, "id"))


def test_removing_records_joins_by_memory(spark, tmp_path, factors, monkeypatch):
    path = f"{tmp_path}/state"
    increment.start(keys(spark, range(60)), path)
    increment.update(spark, path, removed=spark.range(0, 60, 7).withColumnRenamed("id", "ord"))
    assert len(factors) > 10 and min(factors) == st.FACTOR
    # the places that are out of date are not broadcast either, once they are many
    monkeypatch.setattr(st, "BROADCAST_NUMBERS", 5)
    found = increment.assignment(spark, path)
    assert "SortMergeJoin" in plan(found) and "BroadcastHashJoin" not in plan(found)
    left = keys(spark, [i for i in range(60) if i % 7])
    assert {tuple(r) for r in found.select("ord", "label").collect()} == {tuple(r) for r in merge.assign_by_keys(left, StagingArea(spark, "test")).collect()}


def test_late_records_join_by_memory(spark, tmp_path, factors):
    path = f"{tmp_path}/state"
    late = [i for i in range(60) if i % 7 == 0]
    increment.start(keys(spark, [i for i in range(60) if i % 7]), path)
    assert "Join" not in plan(increment.assignment(spark, path))  # nothing is out of date yet
    increment.update(spark, path, keys(spark, late))
    assert len(factors) > 10 and min(factors) == st.FACTOR
    increment.compact(spark, path)
    assert "Join" not in plan(increment.assignment(spark, path)) and min(factors) == st.FACTOR
    found = increment.assignment(spark, path).select("ord", "label").collect()
    assert {tuple(r) for r in found} == {tuple(r) for r in merge.assign_by_keys(keys(spark, range(60)), StagingArea(spark, "test")).collect()}


VALUES = ["Coal ", " COAL", "coal", "ore", "Ore", " \t ", "", None, "sea\u3000salt", "Sea  Salt", "\x85x", "é É"]


def test_values_are_settled_and_numbered_where_they_meet(spark, monkeypatch):
    monkeypatch.setattr(skew, "BLOCKS", 4)
    rows = [(p, (p * 31 + i * 7) % 40, v) for p in (1, 2, 3, 17, 50, 99, 100) for i, v in enumerate(VALUES * 2)]
    rows += [(5, None, "Tin"), (5, None, "tin"), (5, 4, "Zinc"), (5, 4, "zinc")]
    children = spark.createDataFrame(rows, "project_id long, ord long, keyword string").repartition(5)
    written, write = [], StagingArea.write
    monkeypatch.setattr(StagingArea, "write", lambda self, df, name, **m: (written.append(df), write(self, df, name, **m))[1])
    found = merge.numbered_values(children, "keyword", StagingArea(spark, "test"), "ids", 100).collect()
    expected = merge.dedupe_values(children, "keyword", "project_id")
    assert sorted(map(str, [(r.project_id, r.keyword, r.ord) for r in found])) == sorted(str((r.project_id, r.keyword, r.ord)) for r in expected.collect())
    ordered = sorted(found, key=lambda r: r.id)
    places = [(r.project_id, -1 if r.ord is None else r.ord) for r in ordered]
    assert [r.id for r in ordered] == list(range(1, len(found) + 1)) and places == sorted(places)
    # spellings are reduced by hashing before they are normalised, and no range is sampled
    below = plan(written[0]).split("regexp_replace", 1)[1]
    assert below.count("HashAggregate(keys=[project_id") == 2 and "rangepartitioning" not in plan(written[0])
    assert len({r["b"] for r in spark.range(1, 101).select(skew.block_of("id", 100).alias("b")).collect()}) <= 4


def test_keys_of_words_are_keys_of_texts(spark):
    texts = [*VALUES, *[f"A{c}b" for c in WHITESPACE], *WHITESPACE, "İX", "ẞ", "漢字", "𝔸", "\u200b"]
    keyed = spark.createDataFrame([(t,) for t in texts], "t string").select(text_key("t").alias("a"), word_key("t").alias("b")).collect()
    assert all(r.a == r.b for r in keyed) and sum(r.a is None for r in keyed) == 3 + len(WHITESPACE)


def test_an_archive_is_merged_by_memory(spark, factors, monkeypatch):
    monkeypatch.setattr(st, "BROADCAST_NUMBERS", 5)
    projects = spark.range(20).selectExpr("id", "concat('u', id div 2) as project_url")
    words = spark.range(20).selectExpr("id as project_id", "id as id", "if(id % 2 = 0, 'Sea', 'sea') as keyword")
    merged = archive.merge_sources([Source("a", {"projects": projects, "keywords": words}), Source("b", {"projects": projects, "keywords": words})])
    assert len(factors) > 5 and min(factors) == st.FACTOR
    assert sorted(tuple(r) for r in merged.keywords.collect()) == [(i, i, "Sea") for i in range(1, 11)]
    assert merged.projects.count() == 10
    empty = archive.merge_sources([Source("a", {"projects": projects.where("false"), "keywords": words})])
    assert empty.keywords.count() == 0 and empty.projects.count() == 0
