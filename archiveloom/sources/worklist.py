"""What to ask the repositories for."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HITS_PER_QUERY = 25


@dataclass(frozen=True)
class Repository:
    """A configured repository; one without a URL or a token is skipped."""

    name: str
    base_url: str | None
    api_token: str | None


def worklist(terms: DataFrame, repositories: list[Repository], term: str = "term") -> DataFrame:
    """(term, repository, base_url): every term for every usable repository.

    The repositories are configuration, so they travel as an array literal that each term
    is exploded with: a narrow step that keeps the partitioning of the terms.
    """
    usable = [r for r in repositories if r.base_url and r.api_token]
    if not usable:
        return terms.select(term, F.lit("").alias("repository"), F.lit("").alias("base_url")).limit(0)
    targets = F.array(
        *[F.struct(F.lit(r.name).alias("repository"), F.lit(r.base_url).alias("base_url")) for r in usable]
    )
    return terms.select(term, F.inline(targets))


def first_hits(hits: DataFrame, by: list[str], order: list[str], limit: int = HITS_PER_QUERY) -> DataFrame:
    """At most ``limit`` hits per query, in hit order; this cap is the acquisition limit."""
    window = Window.partitionBy(*by).orderBy(*order)
    return hits.withColumn("hit_rank", F.row_number().over(window).cast("bigint")).where(
        F.col("hit_rank") <= limit
    )
