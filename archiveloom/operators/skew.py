"""Broadcasts behind a check of size, and dense numbers without a single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archiveloom.staging import StagingArea

# A table of at most this many rows may be broadcast.
BROADCAST_ROWS = 10_000


def broadcast_if_small(dim: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a dimension that is checked to have few rows, else no hint.

    At most ``rows`` + 1 rows are read for the check.
    """
    return F.broadcast(dim) if dim.limit(rows + 1).count() <= rows else dim


# Blocks of groups that :func:`dense_within` counts; their sizes reach the driver.
BLOCKS = 8192


def block_of(group: str, groups: int) -> Column:
    """The block of a group numbered from 1 to ``groups``: neighbours, in order."""
    return F.shiftright(F.col(group) - 1, max(0, (groups - 1).bit_length() - (BLOCKS - 1).bit_length()))


def dense_within(staging: StagingArea, rows: DataFrame, order: list[Column | str], name: str, block: str, column: str = "id") -> DataFrame:
    """:func:`dense_numbers` of rows that lie with all others of their block, which must come first in ``order``.

    The rows are not moved again: a block is numbered where it is, from the sizes of the blocks before it.
    """
    slot = f"_{column}_slot"
    placed = rows.sortWithinPartitions(*order).withColumn(slot, F.monotonically_increasing_id())
    staged, _ = staging.write(placed, name)
    sizes = staged.groupBy(block).agg(F.min(slot).alias("first"), F.count(F.lit(1)).alias("n")).collect()
    offsets, total = [], 0
    for size in sorted(sizes, key=lambda r: r[block]):
        offsets.append((size[block], total - size["first"]))
        total += size["n"]
    table = rows.sparkSession.createDataFrame(offsets, f"{block} long, _offset long")
    return staged.join(F.broadcast(table), block).withColumn(column, F.col("_offset") + F.col(slot) + 1).drop(block, "_offset", slot)


def dense_numbers(
    staging: StagingArea, keys: DataFrame, order: list[Column | str], name: str, column: str = "id"
) -> DataFrame:
    """Number rows 1..n in ``order`` without sending them through one task.

    Rows are range-partitioned and sorted; each partition numbers its own rows and gets an
    offset from the sizes of the partitions before it. Only those sizes (one row per
    partition) reach the driver. The sorted rows are staged first, so the two passes see
    the same partitions even when executors are lost in between.
    """
    slot = f"_{column}_slot"
    ranged = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    staged, _ = staging.write(ranged.withColumn(slot, F.monotonically_increasing_id()), name)
    part = F.shiftright(F.col(slot), 33)
    sizes = staged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")).collect()
    offsets, total = [], 0
    for size in sorted(sizes, key=lambda r: r["_part"]):
        offsets.append((size["_part"], total))
        total += size["n"]
    table = keys.sparkSession.createDataFrame(offsets, "_part long, _offset long")
    within = F.col(slot).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        staged.withColumn("_part", part)
        .join(F.broadcast(table), "_part")
        .withColumn(column, F.col("_offset") + within + 1)
        .drop("_part", "_offset", slot)
    )
