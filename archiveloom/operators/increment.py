"""The merge of a growing set of catalogues, without merging all of it again.

What a record joins depends on every earlier record it can meet, so a late source of a low rank may
change old decisions. But records of different linked components never meet. The stored state
therefore has, for every record, its match keys, its cluster and its component; new records
touch the components with which they share a key, removed ones the component they were in,
and only the records of touched components are merged again, by the same operator as in a
full run. All other clusters are what a full run would make of them.

The state is a table of :class:`~archiveloom.sources.snapshots.Snapshots` that is only ever added to.
A run adds the records it merged as one generation, and the places of records that are thereby
out of date; a reader takes each record's last generation. :func:`compact` folds generations
into one. A run commits at its end or not at all, and two runs at once cannot both commit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archiveloom.operators.merge import assign_linked
from archiveloom.sources.snapshots import Snapshots
from archiveloom.staging import StagingArea, shuffled_if_large, sized

RECORDS, OUTDATED = "records", "outdated"
KEY_COLUMNS = ("ord", "url_key", "doi_key", "title_key", "repo", "url_set", "doi_set", "title_set", "filled")


@dataclass(frozen=True)
class Change:
    """What a run did: new records, removed ones, stored records merged again, and components."""

    version: int
    added: int
    removed: int
    merged_again: int
    touched: int


def _carried(keys: DataFrame, *more: str) -> DataFrame:
    """(kind, key, ...): the texts by which records can meet; repositories do not keep titles apart."""
    texts = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("key")) for c in ("url_key", "doi_key", "title_key")])
    return keys.select(*more, F.inline(texts)).where(F.col("key").isNotNull())


def _stored(snapshots: Snapshots, version: int | None = None) -> DataFrame:
    """Every record's last generation."""
    records = snapshots.read(RECORDS, version)
    outdated = snapshots.read(OUTDATED, version)
    places = outdated.count()  # by the files' footers
    if not places:
        return records
    upto = shuffled_if_large(outdated.groupBy("ord").agg(F.max("generation").alias("_upto")), places)
    current = records.join(upto, "ord", "left").where(F.col("_upto").isNull() | (F.col("generation") >= F.col("_upto")))
    return current.drop("_upto")


def assignment(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(ord, label, component) of every record."""
    return _stored(Snapshots(spark, path), version).select("ord", "label", "component")


def changed(spark: SparkSession, path: str, since: int, version: int | None = None) -> DataFrame:
    """(ord, label, was): records whose cluster is another than in version ``since``.

    ``was`` is NULL for new records, ``label`` for removed ones.
    """
    snapshots = Snapshots(spark, path)
    old, new = _stored(snapshots, since), _stored(snapshots, version)
    both = new.select("ord", "label").join(old.select("ord", F.col("label").alias("was")), "ord", "full")
    return both.where(~F.col("label").eqNullSafe(F.col("was"))).select("ord", "label", "was")


def _merged(keys: DataFrame, staging: StagingArea, generation: int) -> DataFrame:
    return keys.join(assign_linked(keys, staging), "ord").select(
        *KEY_COLUMNS, "label", "component", F.lit(generation).cast("long").alias("generation")
    )


@sized
def start(keys: DataFrame, path: str) -> Change:
    """Merge all records and store the state under ``path``; ``keys`` are match keys."""
    spark = keys.sparkSession
    staging = StagingArea(spark, "increment")
    draft = Snapshots(spark, path).draft()
    if draft.base:
        raise ValueError(f"{path}: there is a state already")
    keys, seen = staging.write(keys.select(*KEY_COLUMNS), "keys", n=F.count(F.lit(1)))
    draft.write(RECORDS, _merged(keys, staging, 0))
    draft.write(OUTDATED, spark.createDataFrame([], "ord long, generation long"))
    done = draft.commit(generation=0)
    return Change(done.version, seen["n"], 0, 0, 0)


@sized
def update(spark: SparkSession, path: str, added: DataFrame | None = None, removed: DataFrame | None = None) -> Change:
    """Add records (match keys) and remove others (a column ``ord``); the rest stays as it is.

    An added record whose place is taken replaces the one stored there. Places to remove that
    hold no record are passed over. Key columns of the whole state are read, and nothing of
    components that are not touched is written.
    """
    staging = StagingArea(spark, "increment")
    draft = Snapshots(spark, path).draft()
    if not draft.base:
        raise LookupError(f"{path}: no state to update")
    generation = draft.info["generation"] + 1
    stored = _stored(Snapshots(spark, path), draft.base.version)
    if added is None:
        added = stored.where("false")
    new, seen = staging.write(added.select(*KEY_COLUMNS), "new", n=F.count(F.lit(1)))
    gone = new.select("ord") if removed is None else new.select("ord").union(removed.select("ord"))
    gone, dropped = staging.write(stored.join(gone.distinct(), "ord", "left_semi").select("ord", "component"), "gone", n=F.count(F.lit(1)))
    met = _carried(stored, "component").join(_carried(new).distinct(), ["kind", "key"], "left_semi").select("component")
    touched, components = staging.write(met.union(gone.select("component")).distinct(), "touched", n=F.count(F.lit(1)))
    members, kept = staging.write(
        stored.join(touched, "component", "left_semi").join(gone.select("ord"), "ord", "left_anti").select(*KEY_COLUMNS), "members", n=F.count(F.lit(1)),
    )
    again, _ = staging.write(members.union(new), "again")
    draft.write(RECORDS, _merged(again, staging, generation), add=True)
    outdated = members.select("ord").union(gone.select("ord")).withColumn("generation", F.lit(generation).cast("long"))
    draft.write(OUTDATED, outdated, add=True)
    done = draft.commit(generation=generation)
    replaced = new.join(gone, "ord", "left_semi").count() if dropped["n"] and seen["n"] else 0
    return Change(done.version, seen["n"] - replaced, dropped["n"] - replaced, kept["n"], components["n"])


@sized
def compact(spark: SparkSession, path: str) -> int:
    """Fold all generations into one; returns the new version."""
    snapshots = Snapshots(spark, path)
    draft = snapshots.draft()
    generation = draft.info["generation"]
    draft.write(RECORDS, _stored(snapshots, draft.base.version).withColumn("generation", F.lit(generation).cast("long")))
    draft.write(OUTDATED, spark.createDataFrame([], "ord long, generation long"))
    return draft.commit().version
