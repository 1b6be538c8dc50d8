"""Sharding (8): proportional stratified interleaving.

Rows are shuffled within each source by a seeded hash and ranked; sorting all rows by their
fractional rank ``(rank + 0.5) / rows of the source`` spreads every source evenly over the
whole order, and cutting that order into equal pieces gives shards whose mixture is the
corpus's mixture to within one row per source and shard boundary.

Law: ``rows``. Shards differ by one row at most. Copies of a text are separate rows.

Defined results: a NULL source is a source of its own; a NULL text has no bytes; rows that are
equal in id and text are interchangeable, each gets its own slot; a text of any length is one
row, counted whole; an empty table gives no rows; columns named ``shard`` or ``slot`` are
replaced by the operator's own, others, whatever their names, are never looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from archiveloom.llm.names import unused
from archiveloom.llm.ranking import positions, unit
from archiveloom.staging import StagingArea

ROW_BYTES = 16  # what a row takes besides its text


def interleave(df: DataFrame, n_shards: int, seed: int = 8, id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(id, source, size, text_crc32, shard, slot) of every row; texts are read once.

    Only ids, sources, sizes and hashes are shuffled. A source that holds most rows is dealt
    into many cells, so no task ranks a whole source.
    """
    spark = df.sparkSession
    staging = StagingArea(spark, "interleave")
    raw = F.col(text).cast("binary")
    light, seen = staging.write(
        df.select(
            F.col(id).alias("id"),
            F.col(source).alias("source"),
            (F.coalesce(F.octet_length(raw), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(F.coalesce(raw, F.lit(b""))).alias("crc"),
            F.xxhash64(text).alias("text_hash"),
        ),
        "rows",
        n=F.count(F.lit(1)),
    )
    n = seen["n"]
    shuffled = F.xxhash64(F.lit(seed), "id", "text_hash")
    ties = [F.col("id"), F.col("text_hash")]
    ranked = positions(light.withColumn("h", shuffled), unit(F.col("h")), [F.col("h"), *ties], n, ["source"], "rank")
    totals = light.groupBy(F.col("source").alias("_source")).agg(F.count(F.lit(1)).alias("_total"))
    ranked = (
        ranked.join(totals, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("fraction", (F.col("rank") + 0.5) / F.col("_total"))
        .drop("_source", "_total")
    )
    # sources of one size tie on every fraction: a hash of source and rank takes turns
    turn = F.xxhash64(F.lit(seed), "source", "rank")
    placed = positions(ranked, F.col("fraction"), [turn, F.col("source"), *ties], n, out="position")
    start = F.expr(f"(shard * {n} + {n_shards - 1}) div {n_shards}")
    return (
        placed.withColumn("shard", F.expr(f"position * {n_shards} div {max(n, 1)}").cast("int"))
        .withColumn("slot", (F.col("position") - start).cast("long"))
        .select(F.col("id").alias(id), F.col("source").alias(source), "size", F.col("crc").alias("text_crc32"), "text_hash", "shard", "slot")
    )


def shard_rows(df: DataFrame, n_shards: int, seed: int = 8, id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``df`` with ``shard`` and ``slot``.

    Rows that are equal in id, source and text are told apart by counting them. Texts are
    shuffled twice, to count equal rows and to meet their places.
    """
    rows = df.drop("shard", "slot")
    i, s, h, n, mine_h, mine_n = unused(rows, "_id", "_source", "_hash", "_number", "_mine", "_copy")
    copy = lambda cols: F.row_number().over(Window.partitionBy(*cols).orderBy(F.lit(0)))
    placed = interleave(df, n_shards, seed, id, source, text).select(
        F.col(id).alias(i), F.col(source).alias(s), F.col("text_hash").alias(h), "shard", "slot"
    )
    theirs = placed.withColumn(n, copy([i, s, h]))
    mine = rows.withColumn(mine_h, F.xxhash64(text)).withColumn(mine_n, copy([id, source, mine_h]))
    same = (
        F.col(id).eqNullSafe(F.col(i)) & F.col(source).eqNullSafe(F.col(s))
        & (F.col(mine_h) == F.col(h)) & (F.col(mine_n) == F.col(n))
    )
    return mine.join(theirs, same).drop(i, s, h, n, mine_h, mine_n)


def write_shards(df: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order; ``df`` comes from :func:`shard_rows`."""
    df.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
