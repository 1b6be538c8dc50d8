"""Mixing sources to target weights (2): Poisson replication.

Each source gets a mean repetition rate, the bytes it shall have over the bytes it has. Each
document draws its number of copies from a Poisson distribution with that mean, by inverting
the distribution at a uniform number hashed from seed, id and text. Copies are exploded and
shuffled globally by a hash of id, text and copy. Nothing depends on partitions or order, so a
lost task draws the same copies again.

Defined results: a NULL text has no bytes; a NULL source is a source of its own; a source
without a target weight is left out of the mixture; rows that share an id, or have none, draw
by their texts, and rows equal in id and text draw equal numbers of copies and lie together; a
text of any length counts whole; an empty table gives no rows; columns named ``copy`` or
``shuffle_key`` are replaced by the operator's own, all others keep their values whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from archiveloom.llm.names import unused
from archiveloom.operators.skew import broadcast_if_small

# A mean above this is drawn as a sum of independent Poisson numbers with smaller means, so
# that exp(-mean) stays a normal double.
PIECE_MEAN = 256.0


def uniform(*parts: Column | str) -> Column:
    """A number evenly spread over (0, 1) from 52 bits of md5; DuckDB computes the same."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + 0.5) / F.lit(float(1 << 52))


def tempered(sizes: DataFrame, exponent: float) -> DataFrame:
    """(source, weight): each source's share raised to a power, normalised by the caller."""
    return sizes.select("source", F.pow(F.col("size").cast("double"), F.lit(exponent)).alias("weight"))


def source_sizes(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """(source, size): bytes of text, and one for each row so that no source is empty."""
    size = F.coalesce(F.octet_length(text), F.lit(0)) + 1
    return docs.groupBy(F.col(source).alias("source")).agg(F.sum(size).cast("long").alias("size"))


def rates(sizes: DataFrame, weights: DataFrame, total_bytes: float | None = None) -> DataFrame:
    """(source, rate): mean copies of a document, for ``total_bytes`` of output (as the input).

    ``weights`` are (source, weight); they need not add up to one.
    """
    every = Window.partitionBy(F.lit(0))  # the tables have a row per source
    total = F.lit(float(total_bytes)) if total_bytes is not None else F.sum("size").over(every)
    wanted = weights.select(F.col("source").alias("_source"), (F.col("weight") / F.sum("weight").over(every)).alias("share"))
    return (
        sizes.withColumn("total", total)
        .join(wanted, F.col("source").eqNullSafe(F.col("_source")))
        .select("source", (F.col("share") * F.col("total") / F.col("size")).alias("rate"))
    )


def poisson_table(rate: DataFrame) -> DataFrame:
    """Adds ``pieces`` and ``cdf``, P(0..k) as far as doubles tell the sum from one."""
    mean = "(rate / pieces)"
    return (
        rate.withColumn("pieces", F.greatest(F.lit(1), F.ceil(F.col("rate") / PIECE_MEAN)).cast("int"))
        .withColumn("top", F.expr(f"cast(ceil({mean} + 12 * sqrt({mean}) + 30) as int)"))
        .withColumn(
            "cdf",
            F.expr(
                f"""aggregate(sequence(1, top),
                named_struct('p', exp(-{mean}), 'c', exp(-{mean}), 'all', array(exp(-{mean}))),
                (s, k) -> named_struct('p', s.p * {mean} / k, 'c', s.c + s.p * {mean} / k,
                                       'all', array_append(s.all, s.c + s.p * {mean} / k)),
                s -> s.all)"""
            ),
        )
        .select(F.col("source").alias("_source"), "rate", "pieces", "cdf")
    )


def replicate(
    docs: DataFrame, rate: DataFrame, seed: int = 2, id: str = "doc_id", source: str = "source", text: str = "text"
) -> DataFrame:
    """Every document as often as it draws, with ``copy`` from 0 and ``shuffle_key``, in random order.

    ``rate`` is (source, rate). The table of rates is broadcast only if it has few rows; else
    Spark joins it, splitting sources that hold many documents.
    """
    docs = docs.drop("copy", "shuffle_key")
    to, pieces, cdf, who, count = unused(docs, "_source", "_pieces", "_cdf", "_who", "_count")
    table = broadcast_if_small(
        poisson_table(rate).select(F.col("_source").alias(to), F.col("pieces").alias(pieces), F.col("cdf").alias(cdf))
    )
    known = F.concat_ws(":", F.coalesce(F.col(id).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    numbers = F.transform(F.sequence(F.lit(1), F.col(pieces)), lambda j: uniform(F.lit(seed), F.col(who), j))
    draws = F.transform(numbers, lambda u: F.size(F.filter(cdf, lambda c: c < u)))
    order = F.md5(F.concat_ws(":", F.lit(f"{seed}-order"), F.col(who), "copy").cast("binary"))
    copies = (
        docs.withColumn(who, known)
        .join(table, F.col(source).eqNullSafe(F.col(to)))
        .withColumn(count, F.aggregate(draws, F.lit(0), lambda a, x: a + x))
        .where(F.col(count) > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col(count) - 1)))
        .withColumn("shuffle_key", F.conv(F.substring(order, 1, 15), 16, 10).cast("long"))
        .select(*docs.columns, "copy", "shuffle_key")
    )
    return copies.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
