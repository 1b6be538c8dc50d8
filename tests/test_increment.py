"""Late and removed sources, ids that stay, and tables that change at once."""


import pytest
from pyspark.sql import functions as F

from archiveloom.operators import increment, ledger, merge
from archiveloom.schema import Archive
from archiveloom.sources import sinks
from archiveloom.sources.snapshots import Conflict, Snapshots
from conftest import rows
from test_merge import SCHEMA, chain, random_sets


@pytest.fixture(scope="module")
def keys(spark):
    records = random_sets(250, 41, True) + chain(10**6, 20, "a", True)
    df = spark.createDataFrame([tuple(r)[:5] for r in records], SCHEMA)
    staging = merge.StagingArea(spark, "test")
    return merge.stage_keys(df, staging)


def labels(df):
    return {r["ord"]: r["label"] for r in df.collect()}


def full(spark, keys):
    return labels(merge.assign_by_keys(keys, merge.StagingArea(spark, "test")))


def test_updates_equal_a_full_merge(spark, keys, tmp_path):
    """Records come late from anywhere in the order, are replaced and go again."""
    path = f"{tmp_path}/state"
    late = F.pmod(F.xxhash64("ord"), F.lit(5))
    first = increment.start(keys.where(late > 1), path)
    early = full(spark, keys.where(late > 1))
    assert labels(increment.assignment(spark, path)) == early
    few = keys.where((late == 1) & (F.col("ord") < 3000))  # touches a few components only
    done = increment.update(spark, path, few)
    expected = keys.where((late > 1) | ((late == 1) & (F.col("ord") < 3000)))
    assert labels(increment.assignment(spark, path)) == full(spark, expected)
    assert done.added == few.count() and done.removed == 0 and 0 < done.merged_again < 0.25 * first.added
    moved = increment.changed(spark, path, first.version)
    assert moved.where("was is null").count() == done.added and moved.count() <= done.added + done.merged_again
    # one record changes its keys, one goes, one that is not there is asked to go
    gone = spark.createDataFrame([(few.first()["ord"],), (987654321,)], "ord long")
    other = keys.where(late > 1).orderBy("ord").limit(1).withColumn("doi_key", F.lit("another")).withColumn("doi_set", F.lit(True))
    done = increment.update(spark, path, other, gone)
    assert (done.added, done.removed) == (0, 1)
    expected = expected.join(gone, "ord", "left_anti").join(other, "ord", "left_anti").unionByName(other)
    assert labels(increment.assignment(spark, path)) == full(spark, expected)
    before = labels(increment.assignment(spark, path))
    increment.compact(spark, path)
    assert labels(increment.assignment(spark, path)) == before
    assert Snapshots(spark, path).read("outdated").count() == 0
    assert labels(increment.assignment(spark, path, first.version)) == early
    nothing = increment.update(spark, path)
    assert (nothing.added, nothing.removed, nothing.merged_again, nothing.touched) == (0, 0, 0, 0)


def test_an_update_that_lost_changes_nothing(spark, keys, tmp_path, monkeypatch):
    path = f"{tmp_path}/state"
    increment.start(keys.where("ord < 2000"), path)
    before = labels(increment.assignment(spark, path))
    commit = Snapshots.commit
    with monkeypatch.context() as m:
        m.setattr(Snapshots, "commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):  # killed just before the end
            increment.update(spark, path, keys.where("ord between 2000 and 2500"))
    assert labels(increment.assignment(spark, path)) == before

    def overtaken(self, based_on, *rest):
        commit(self, based_on, *rest)  # somebody else
        return commit(self, based_on, *rest)

    with monkeypatch.context() as m:
        m.setattr(Snapshots, "commit", overtaken)
        with pytest.raises(Conflict):
            increment.update(spark, path, keys.where("ord between 2000 and 2500"))


def test_ids_stay(spark, tmp_path):
    path = f"{tmp_path}/ledger"
    frame = lambda pairs: spark.createDataFrame(pairs, "ord long, label long")
    ids = lambda pairs: {r["label"]: r["id"] for r in ledger.stable_ids(frame(pairs), path).collect()}
    assert ids([(10, 10), (11, 10), (20, 20), (30, 30)]) == {10: 1, 20: 2, 30: 3}
    # an earlier record opens the first cluster now; a new cluster comes before all
    assert ids([(5, 5), (8, 8), (10, 8), (11, 8), (20, 20), (30, 30)]) == {5: 4, 8: 1, 20: 2, 30: 3}
    # two clusters become one, another one is split, one is gone
    assert ids([(5, 5), (20, 5), (8, 8), (10, 10), (11, 10)]) == {5: 2, 10: 1, 8: 5}
    assert rows(ledger.forwarded(spark, path)) == [(4, 2)]
    assert ids([(5, 5), (8, 5), (10, 5), (20, 5)]) == {5: 1}
    assert rows(ledger.forwarded(spark, path)) == [(2, 1), (4, 1), (5, 1)]
    assert ids([(5, 5), (30, 30), (40, 40)]) == {5: 6, 30: 3, 40: 7}  # 30 comes back; 5's id is retired
    assert ids([]) == {}


def test_snapshots(spark, tmp_path):
    shots = Snapshots(spark, f"{tmp_path}/shots")
    assert shots.latest() is None
    frame = lambda *values: spark.createDataFrame([(v,) for v in values], "v int")
    one, two = shots.draft(), shots.draft()
    one.write("t", frame(1, 2))
    two.write("t", frame(9))
    assert one.commit(by="one").version == 1
    with pytest.raises(Conflict):
        two.commit()
    assert rows(shots.read("t")) == [(1,), (2,)]
    more = shots.draft()
    more.write("t", frame(3), add=True)
    more.write("empty", frame(0).where("false"))
    assert more.commit().info == {"by": "one"} and rows(shots.read("t")) == [(1,), (2,), (3,)]
    assert shots.read("empty").columns == ["v"] and shots.read("empty").count() == 0
    with pytest.raises(ValueError, match="schema"):
        shots.draft().write("t", frame(1).withColumn("w", F.lit(1)), add=True)
    # a manifest that a killed writer left is passed over, and so is its number
    (tmp_path / "shots" / "_versions" / "0000000003.json").write_text('{"version": 3, "par')
    assert shots.latest().version == 2
    assert shots.rollback(1).version == 4 and rows(shots.read("t")) == [(1,), (2,)] and rows(shots.read("t", 2)) == [(1,), (2,), (3,)]
    assert shots.clean(keep=1) == [] and len(shots.clean(keep=1, older_than=-60)) == 2  # the lost draft, the one rolled back
    assert rows(shots.read("t")) == [(1,), (2,)]
    with pytest.raises(LookupError):
        shots.read("t", 77)


def test_a_killed_publish_leaves_the_old_archive(spark, tmp_path, monkeypatch):
    good = lambda n: Archive(
        spark.range(n).selectExpr(
            "id", "1L as repository_id", "'r' as repository_url", "concat('u', id) as project_url", "'t' as title", "'d' as description",
            "timestamp'2024-01-01' as download_date", "'a' as download_repository_folder", "'b' as download_project_folder", "'API-CALL' as download_method",
        ),
        licenses=spark.range(n).selectExpr("id", "id as project_id", "'CC0' as license"),
    )
    path = f"{tmp_path}/archive"
    read = lambda version=None: tuple(df.count() for df in sinks.read_tables(spark, path, ["projects", "licenses"], version).tables().values())
    assert sinks.publish(good(3), path, apply=True) == [] and read() == (3, 3)
    written = []
    show = sinks.published

    def dying(entity, df):
        written.append(entity)
        if entity == "licenses":
            raise KeyboardInterrupt
        return show(entity, df)

    with monkeypatch.context() as m:
        m.setattr(sinks, "published", dying)
        with pytest.raises(KeyboardInterrupt):
            sinks.publish(good(5), path, apply=True)
    assert written == ["projects", "licenses"] and read() == (3, 3)
    assert sinks.publish(good(5), path, apply=True) == [] and read() == (5, 5) and read(1) == (3, 3)
    sinks.write_tables(good(2), f"{tmp_path}/plain")  # tables without versions are read as they are
    assert sinks.read_tables(spark, f"{tmp_path}/plain", ["projects"]).projects.count() == 2
