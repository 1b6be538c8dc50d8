"""Cluster ids that stay the same from run to run.

:func:`~archiveloom.operators.merge.surrogate_ids` numbers clusters in the order they were opened, so one
more record at the beginning moves all numbers. Here an id belongs to a founder, the record that
opened the cluster when it got its id, and a ledger keeps all founders. In a later run a cluster
has the smallest id among the founders that are its members; if there are several, clusters have been
merged and the other ids are retired, with the id that took their place. A cluster without a founder
is new. A cluster that was split leaves its id with the part that holds the founder.

New ids are one range above all ids ever given out, numbered in the order of the new clusters. The range
is taken by committing the ledger's next version, so two runs at once cannot give out the same ids.
The ledger only grows: a run writes its new founders and what it retires.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archiveloom.operators.skew import dense_numbers
from archiveloom.sources.snapshots import Snapshots
from archiveloom.staging import StagingArea

FOUNDERS, RETIRED = "founders", "retired"


def stable_ids(assignment: DataFrame, path: str) -> DataFrame:
    """(label, id) of every cluster, ids of earlier runs kept; the ledger is under ``path``.

    ``assignment`` is (ord, label). Places of records must mean the same in every run, as they do
    where sources keep their ranks.
    """
    spark = assignment.sparkSession
    staging = StagingArea(spark, "ledger")
    snapshots = Snapshots(spark, path)
    draft = snapshots.draft()
    taken = draft.info.get("next", 1) - 1
    labels = assignment.where("ord = label").select("label")
    if draft.base:
        live = founders(spark, path, draft.base.version)
        found = assignment.join(live.select(F.col("founder").alias("ord"), "id"), "ord")
        # founders that meet in one cluster are what is merged: every id is one of few in its cluster
        keeps = found.groupBy("label").agg(F.min("id").alias("_keeps"))
        found, _ = staging.write(found.select("label", "id").join(keeps, "label"), "found")
        known = found.where("id = _keeps").select("label", "id")
        draft.write(RETIRED, found.where("id <> _keeps").select("id", F.col("_keeps").alias("into")), add=True)
    else:
        known = spark.createDataFrame([], "label long, id long")
        draft.write(RETIRED, spark.createDataFrame([], "id long, into long"))
    fresh = labels.join(known.select("label"), "label", "left_anti")
    numbered = dense_numbers(staging, fresh, ["label"], "fresh").withColumn("id", F.col("id") + taken)
    opened = draft.write(FOUNDERS, numbered.select(F.col("label").alias("founder"), "id"), add=True)
    given = opened.agg(F.max("id")).first()[0]
    draft.commit(next=(given or taken) + 1)
    return known.union(opened.select(F.col("founder").alias("label"), "id"))


def founders(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(founder, id) of ids that are not retired."""
    snapshots = Snapshots(spark, path)
    return snapshots.read(FOUNDERS, version).join(snapshots.read(RETIRED, version).select("id"), "id", "left_anti").select("founder", "id")


def forwarded(spark: SparkSession, path: str) -> DataFrame:
    """(id, into): every retired id and the live id that stands for it now, over any number of merges."""
    links = Snapshots(spark, path).read(RETIRED)
    staging = StagingArea(spark, "forwarded")
    turn = 0
    while True:
        on = links.select(F.col("id").alias("into"), F.col("into").alias("_next"))
        step = links.join(on, "into", "left").select("id", F.coalesce("_next", "into").alias("into"), F.col("_next").isNotNull().alias("_moved"))
        links, seen = staging.write(step, f"links-{turn % 2}", moved=F.count_if("_moved"))
        links, turn = links.drop("_moved"), turn + 1
        if not seen["moved"]:
            return links
