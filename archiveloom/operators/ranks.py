"""Rank tables, top-N folds and shares over count tables.

Every input here is a table of counts. Equal counts are ordered by an explicit tie column,
so results never depend on partitioning. ``row_number() <= k`` lets Spark keep k rows per
group before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from archiveloom.operators.skew import dense_numbers
from archiveloom.staging import StagingArea

TABLE_ROWS = 20
FILE_TABLE_ROWS = 10
PIE_SLICES = 7
OTHER = "Other"


def _ranked(counts: DataFrame, by: list[str], tie: list[Column]) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("n").desc(), *tie)
    return counts.withColumn("rank", F.row_number().over(order).cast("bigint"))


def rank_table(
    counts: DataFrame, by: list[str], top_n: int = TABLE_ROWS, tie: str = "first_id"
) -> DataFrame:
    """The ``top_n`` largest counts per group, ranked 1..n."""
    return _ranked(counts, by, [F.col(tie).asc_nulls_first()]).where(F.col("rank") <= top_n)


def fold_into_other(
    counts: DataFrame, by: list[str], label: str, top_n: int = PIE_SLICES, tie: str = "first_id"
) -> DataFrame:
    """(by..., slice, label, n): the ``top_n`` largest, the rest summed as ``Other``.

    The rest is the group's total less what was kept, so no group is ever ranked whole.
    """
    top = rank_table(counts, by, top_n, tie)
    total = counts.select(*by, "n", F.lit(1).alias("labels"))
    kept = top.select(*by, (-F.col("n")).alias("n"), F.lit(0).alias("labels"))
    rest = (
        total.unionByName(kept)
        .groupBy(*by)
        .agg(F.sum("n").alias("n"), F.sum("labels").alias("labels"))
        .where(F.col("labels") > top_n)
        .select(*by, F.lit(top_n + 1).cast("bigint").alias("slice"), F.lit(OTHER).alias(label), "n")
    )
    return top.select(*by, F.col("rank").alias("slice"), label, "n").unionByName(rest)


def nonzero(counts: DataFrame) -> DataFrame:
    return counts.where("n > 0")


def share(part: Column, total: Column) -> Column:
    """Percentage, 0 for an empty total; unrounded."""
    return F.when(total > 0, part.cast("double") * F.lit(100.0) / total).otherwise(F.lit(0.0))


def with_share(counts: DataFrame, by: list[str]) -> DataFrame:
    """Adds ``share``: percentage of the group's total."""
    total = F.sum("n").over(Window.partitionBy(*by))
    return counts.withColumn("share", share(F.col("n"), total))


def bar_series(counts: DataFrame, label: str, staging: StagingArea, tie: str = "tie") -> DataFrame:
    """(label, n, position): bars from the smallest to the largest; ties by grouping key."""
    order = [F.col("n").asc(), F.col(tie).asc_nulls_first()]
    columns = counts.select(label, "n", F.col(tie).alias(tie)) if tie != label else counts.select(label, "n")
    return dense_numbers(staging, columns, order, "bars", "position").select(label, "n", "position")
