"""Tags and keywords: the words that set a text apart, by TF-IDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from archiveloom.functions.text import words
from archiveloom.operators.vectors import Embedder, bucket

# English function words that are never tags
STOP_WORDS = (
    "a", "about", "after", "all", "also", "an", "and", "any", "are", "as", "at", "be", "been",
    "but", "by", "can", "do", "for", "from", "had", "has", "have", "he", "her", "his", "how",
    "i", "if", "in", "into", "is", "it", "its", "more", "no", "not", "of", "on", "one", "or",
    "our", "she", "so", "such", "than", "that", "the", "their", "them", "then", "there",
    "these", "they", "this", "to", "was", "we", "were", "what", "when", "which", "who", "will",
    "with", "would", "you", "your",
)
TAGS = 5


def is_candidate(word: Column) -> Column:
    """Words of two or more characters that are not function words."""
    return (F.length(word) >= 2) & ~word.isin(*STOP_WORDS)


def word_counts(fragments: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, word, tf) over all fragments of a key."""
    return (
        fragments.select(key, F.explode(words(F.col(text))).alias("word"))
        .where(is_candidate(F.col("word")))
        .groupBy(key, "word")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def word_scores(fragments: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, word, tf, df, score): score = tf * ln(documents / df).

    Words that occur nearly everywhere make skewed partitions, which adaptive execution splits.
    """
    counts = word_counts(fragments, key, text)
    # a condition on tf, which always holds, keeps it in the plan: both branches then read one shuffle of
    # the same counts, and texts are split once
    frequency = counts.groupBy("word").agg(F.count_if(F.col("tf") > 0).alias("df"))
    # all documents, from the key column alone: the texts are split once
    documents = fragments.agg(F.count_distinct(key)).scalar()
    scored = counts.join(frequency, "word")
    return scored.withColumn(
        "score", F.round(F.col("tf") * F.ln(documents / F.col("df")), 6)
    )


def top_tags(fragments: DataFrame, key: str, text: str = "text", top_n: int = TAGS) -> DataFrame:
    """(key, word, score, rank): the ``top_n`` words per key; ties in word order."""
    order = Window.partitionBy(key).orderBy(F.col("score").desc(), F.col("word"))
    return (
        word_scores(fragments, key, text)
        .withColumn("rank", F.row_number().over(order).cast("bigint"))
        .where(F.col("rank") <= top_n)
        .select(key, "word", "score", "rank")
    )


def nearest_tags(
    fragments: DataFrame, key: str, vectors: DataFrame, embedder: Embedder | None = None, text: str = "text", top_n: int = TAGS
) -> DataFrame:
    """(key, word, score, rank): the candidate words of a key nearest to its vector by cosine.

    ``vectors`` are (key, vector). Each distinct word is embedded once. With the default bag
    of words a word's vector has one non-zero cell, so its cosine is that cell of the key's
    vector over the vector's length. Scores count to nine digits; ties in word order.
    """
    words_of = word_counts(fragments, key, text).select(key, "word")
    length = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    scored = vectors.select(key, "vector", F.nullif(length(F.col("vector")), F.lit(0.0)).alias("_length"))
    if embedder is None:
        scored = words_of.join(scored, key).withColumn("score", F.element_at("vector", bucket(F.col("word")) + 1) / F.col("_length"))
    else:
        known = words_of.select("word").distinct().withColumn("_word", embedder(F.col("word")).cast("array<double>"))
        known = known.withColumn("_word_length", F.nullif(length(F.col("_word")), F.lit(0.0)))
        dot = F.aggregate(F.zip_with("vector", "_word", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
        scored = words_of.join(known, "word").join(scored, key).withColumn("score", dot / (F.col("_length") * F.col("_word_length")))
    order = Window.partitionBy(key).orderBy(F.col("score").desc(), F.col("word"))
    return (
        scored.select(key, "word", F.round(F.coalesce("score", F.lit(0.0)), 9).alias("score"))
        .withColumn("rank", F.row_number().over(order).cast("bigint"))
        .where(F.col("rank") <= top_n)
    )


def tag_arrays(tags: DataFrame, key: str) -> DataFrame:
    """(key, tags): ranked tags as one array per key, at most ``top_n`` long."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", "word")))
    return tags.groupBy(key).agg(F.transform(ranked, lambda t: t["word"]).alias("tags"))


def ingest_keywords(studies: DataFrame, key: str, top_n: int = TAGS) -> DataFrame:
    """(key, keyword) of landed studies with ``notes``, ``abstract`` and ``data_kind``.

    Words come from notes and abstract together, and only where there are notes; the data
    kind is added; each keyword once.
    """
    both = studies.where(F.col("notes") != "").select(
        key, F.concat("notes", F.coalesce("abstract", F.lit(""))).alias("text")
    )
    picked = top_tags(both, key, top_n=top_n).select(key, F.col("word").alias("keyword"))
    kinds = studies.where(F.col("data_kind") != "").select(key, F.col("data_kind").alias("keyword"))
    return picked.union(kinds).distinct()
