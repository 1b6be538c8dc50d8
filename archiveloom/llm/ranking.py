"""Positions in a sorted order without one task holding a whole group.

Shared by the operators that number rows: rows are dealt into cells by a value that is spread
evenly over 0 to 1, each cell is numbered by itself, and the sizes of the cells before it, one
row per cell, are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows a cell holds on average; a group of any size has as many cells as it fills.
CELL_ROWS = 50_000


def unit(h: Column) -> Column:
    """A 64-bit hash as a double from 0 up to, not including, 1."""
    return F.shiftrightunsigned(h, 11) / F.lit(float(1 << 53))


def positions(
    df: DataFrame, spread: Column, order: list[Column], rows: int, within: list[str] | None = None, out: str = "pos"
) -> DataFrame:
    """``df`` with ``out``: rank from 0 by (``spread``, ``order``) within each group.

    ``spread`` must be evenly spread over [0, 1); ``rows`` is the number of rows, which sets
    the number of cells. ``df`` is read twice and should be cheap to read.
    """
    within = within or []
    cells = max(1, -(-rows // CELL_ROWS))
    df = df.withColumn("_spread", spread).withColumn("_cell", F.floor(F.col("_spread") * cells))
    sizes = df.groupBy(*within, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    # NULL groups join too
    keys = [F.struct(*within, F.lit(0)) if within else F.lit(0)]
    before = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(c).alias(f"_g_{c}") for c in within],
        F.col("_cell").alias("_g_cell"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
    )
    inside = Window.partitionBy(*within, "_cell").orderBy("_spread", *order)
    same = F.col("_cell") == F.col("_g_cell")
    for c in within:
        same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return (
        df.withColumn("_row", F.row_number().over(inside))
        .join(offsets, same)
        .withColumn(out, F.col("_offset") + F.col("_row") - 1)
        .drop("_spread", "_cell", "_row", "_offset", "_g_cell", *[f"_g_{c}" for c in within])
    )
