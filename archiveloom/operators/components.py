"""Linked components of records that share a key, by alternating star contractions.

Each round replaces edges by edges to smaller neighbours (the large-star / small-star
scheme of Kiveris et al., "Connected Components in MapReduce and Beyond", 2014), which
needs a number of rounds that grows with the logarithm of the component, not its diameter.
A hub with many neighbours is only ever aggregated (a partial minimum) or looked up by a join,
whose skewed partitions adaptive execution splits; it is never gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archiveloom.operators.merge import stage_keys
from archiveloom.staging import StagingArea


def key_edges(keys: DataFrame) -> DataFrame:
    """(hi, lo): every record to the smallest record with the same URL, DOI or title key.

    ``keys`` are the match keys; the title key goes with the record's own repository. One
    edge per record and key.
    """
    none = F.lit(0).cast("bigint")
    tier = lambda name, key, k2: F.struct(F.lit(name).alias("tier"), F.col(key).alias("key"), k2.alias("k2"))
    tiers = F.array(
        tier("url", "url_key", none), tier("doi", "doi_key", none), tier("title", "title_key", F.col("repo"))
    )
    carried = keys.select("ord", F.inline(tiers)).where(
        F.col("key").isNotNull() & F.col("k2").isNotNull()
    )
    on = ["tier", "key", "k2"]
    smallest = (
        carried.groupBy(*on)
        .agg(F.min("ord").alias("lo"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    linked = carried.join(smallest.drop("n"), on)
    return linked.where("ord > lo").select(F.col("ord").alias("hi"), "lo").distinct()


def components(edges: DataFrame, staging: StagingArea | None = None) -> DataFrame:
    """(node, component) for every node on an edge; a component is named by its smallest node."""
    staging = staging or StagingArea(edges.sparkSession, "components")
    count = F.count(F.lit(1))
    digest = {"n": count, "h": F.bit_xor(F.xxhash64("hi", "lo"))}
    edges, before = staging.write(edges, "edges", **digest)
    round_no = 0  # folders are reused, so at most two rounds are stored
    while before["n"]:
        both = edges.union(edges.select("lo", "hi")).toDF("hi", "lo")
        near = (
            both.groupBy("hi")
            .agg(F.min("lo").alias("m"))
            .select(F.col("hi").alias("lo"), F.least("hi", "m").alias("m"))
        )
        large = (
            edges.join(near, "lo")
            .select("hi", F.col("m").alias("lo"))
            .distinct()
        )
        large, _ = staging.write(large, "large")
        below = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(below, "hi")
            .where("lo > m")
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .union(below.select("hi", F.col("m").alias("lo")))
            .distinct()
        )
        edges, after = staging.write(small, f"small-{round_no % 2}", **digest)
        if after == before:
            break
        before, round_no = after, round_no + 1
    tails = edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    heads = edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return tails.union(heads)


def link_components(projects: DataFrame, staging: StagingArea | None = None) -> DataFrame:
    """(ord, component): records connected by shared keys, each record once.

    This is the closure of the match relation. The merge itself is finer; use this to audit
    it or, knowingly, as a coarser merge.
    """
    staging = staging or StagingArea(projects.sparkSession, "components")
    return link_by_keys(stage_keys(projects, staging), staging)


def link_by_keys(keys: DataFrame, staging: StagingArea) -> DataFrame:
    """:func:`link_components` from staged keys."""
    linked = components(key_edges(keys), staging).withColumnRenamed("node", "ord")
    return keys.select("ord").join(linked, "ord", "left").select(
        "ord", F.coalesce("component", "ord").alias("component")
    )
