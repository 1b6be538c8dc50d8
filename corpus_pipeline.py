"""The corpus pipeline: documents through five of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; :func:`run` writes every
stage's rows as Parquet in the shared folder and reads them again as the next stage's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from archiveloom.llm import decontam, jaccard, langid, mixing, sharding
from archiveloom.llm.queries import MIX_EXPONENT, MIX_SEED, N_SHARDS, table
from archiveloom.staging import StagingArea

NEAR_WORDS, NEAR_PERCENT = 5, 80  # words of a shingle, and the similarity from which documents link


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; learned from the labelled ones."""
    found = langid.identified(docs, langid.fit(docs))
    return found.where(~F.col("rejected")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked ones: the one with the smallest id, a NULL id last.

    A row is known by its id and a 128-bit digest of its text, so rows that share an id, or have
    none, go only if their texts link. Wordless rows link with nothing and all stay. Rows of one
    id and text are reduced to one before texts are shuffled, which happens once.
    """
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    id = F.coalesce(F.col("doc_id").cast("long"), F.lit(int(jaccard.LAST_ID)))
    digests = {"_a": F.xxhash64("text"), "_b": F.xxhash64(F.lit(1), "text")}
    rows = docs.where(worded).withColumns({"_id": id, **digests})
    groups = jaccard.placed(rows, NEAR_WORDS, NEAR_PERCENT, "doc_id", "text", tuple(digests))
    first = groups.groupBy("component").agg(F.min(F.struct(F.col("id").alias("_id"), *digests)).alias("_first"))
    one = Window.partitionBy("_id", *digests).orderBy(*[c for c in docs.columns if c != "text"])
    single = rows.withColumn("_n", F.row_number().over(one)).where("_n = 1")
    # an inner join: a semi join would be moved before the window, and one id's copies into one task
    stay = single.join(first.select("_first.*"), ["_id", *digests])
    return stay.select(*docs.columns).unionByName(docs.where(~worded))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources have their target weights, in random order."""
    sizes = mixing.source_sizes(docs)
    rate = mixing.rates(sizes, mixing.tempered(sizes, MIX_EXPONENT))
    return mixing.replicate(docs, rate, MIX_SEED).select(*docs.columns)


def make_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and its slot there."""
    return sharding.shard_rows(docs, N_SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
    ("sharding", make_shards),
]

# Cosines to learned centroids and hashes of word sets have no SQL form; tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    staging = StagingArea(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs, _ = staging.write(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
