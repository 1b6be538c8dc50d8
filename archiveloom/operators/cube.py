"""The cube of counts kept up to date from changes, without counting all projects again.

Counts are sums, so a changed project adds -1 to the cell it was in and +1 to the cell it is in
now. The smallest id of a cell, which orders equal counts in reports, only follows from the change
if the project that left is not the one that holds it; cells that lose their smallest id are looked
up again among the projects that are in them now. Everything else of the projects is not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archiveloom.operators.counts import class_label
from archiveloom.staging import StagingArea

CELL = ("repository_id", "type", "primary_class")


def cells(projects: DataFrame) -> DataFrame:
    """(repository_id, type, primary_class, n, first_id): the cube before repositories get their labels."""
    return projects.groupBy("repository_id", "type", class_label().alias("primary_class")).agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id")
    )


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per cell what changed: ``n`` more projects, the smallest id that came and the smallest that left.

    ``before`` has the changed projects as they were (none for new ones), ``after`` as they are now
    (none for deleted ones). A project that stays in its cell cancels out.
    """
    cell = ("repository_id", "type", class_label().alias("primary_class"))
    signed = before.select("id", *cell, F.lit(-1).alias("sign")).unionByName(after.select("id", *cell, F.lit(1).alias("sign")))
    moved = signed.groupBy("id", *CELL).agg(F.sum("sign").cast("bigint").alias("sign")).where("sign <> 0")
    return moved.groupBy(*CELL).agg(
        F.sum("sign").alias("n"), F.min(F.when(F.col("sign") > 0, F.col("id"))).alias("came"), F.min(F.when(F.col("sign") < 0, F.col("id"))).alias("left"),
    )


def maintained(cube: DataFrame, before: DataFrame, after: DataFrame, projects: DataFrame) -> DataFrame:
    """``cube`` (see :func:`cells`) after the change; ``projects`` are all projects as they are now.

    Empty cells leave the cube. ``projects`` is read only if cells lost their smallest id, and joined
    with those, at most one per deleted or moved project.
    """
    staging = StagingArea(cube.sparkSession, "cube")
    none = F.lit(None).cast("bigint")
    delta = changes(before, after).withColumn("first_id", none)
    rows = cube.select(*CELL, "n", none.alias("came"), none.alias("left"), "first_id").unionByName(delta)
    # NULL is a type of its own, and grouping treats it as one
    both = rows.groupBy(*CELL).agg(F.sum("n").alias("n"), *[F.min(c).alias(c) for c in ("came", "left", "first_id")]).where("n > 0")
    lost = F.coalesce(F.col("left") <= F.col("first_id"), F.lit(False))
    both, seen = staging.write(
        both.select(*CELL, "n", F.least("first_id", "came").alias("first_id"), lost.alias("lost")), "cells", lost=F.count_if("lost")
    )
    if not seen["lost"]:
        return both.drop("lost")
    wanted = both.where("lost").select(*[F.col(c).alias(f"_{c}") for c in CELL])
    now = projects.select("id", "repository_id", "type", class_label().alias("primary_class"))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in CELL])
    again, _ = staging.write(now.join(wanted, same, "left_semi").groupBy(*CELL).agg(F.min("id").alias("first_id")), "again")
    found = both.where("lost").select(*CELL, "n", none.alias("first_id")).unionByName(again.withColumn("n", none))
    return both.where("not lost").drop("lost").unionByName(
        found.groupBy(*CELL).agg(F.max("n").alias("n"), F.max("first_id").alias("first_id"))
    )
