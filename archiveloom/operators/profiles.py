"""Language of a text by trigram profiles learned from labelled texts.

A profile is a language's commonest character trigrams with their weights. A text's trigrams are
exploded and meet the profiles in a broadcast join, and a language's log-likelihood is a sum, so
what is shuffled is one row per text and language. With add-one smoothing a trigram seen n times among
the T of a language has the probability (n + 1) / (T + V), V the number of different trigrams;
the sum then splits into ``ln(n + 1)`` per known trigram and ``-ln(T + V)`` for each trigram of the text.
Both are kept in millionths, as whole numbers, so sums do not depend on their order.

A profile has at most ``size`` trigrams, which bounds the broadcast table; counts cover all labelled texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from archiveloom.operators.batches import small_batches
from archiveloom.operators.skew import broadcast_if_small
from archiveloom.staging import StagingArea

# All but letters, and letters that take two UTF-16 units, which the trigram pattern would cut
NO_LETTERS = r"(?:[^\p{L}]|[\x{10000}-\x{10FFFF}])+"
SIZE = 1000
MILLION = 1_000_000


def _line(text: Column) -> Column:
    """The lower-cased words, one space around each; no character takes two UTF-16 units."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), NO_LETTERS, " ")), F.lit(" "))


def trigrams(text: Column) -> Column:
    """All runs of three characters of the lower-cased words, one space around each word."""
    return F.regexp_extract_all(_line(text), F.lit("(?=(.{3}))"), 1)


def count_trigrams(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n): how often each of :func:`trigrams` is in the texts of a language.

    ``labelled`` is (lang, text). A trigram is a number of 48 bits while it is counted; counts are
    combined per batch, which is bounded in bytes, before the shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines: dict[str, list[str]] = {}
            for lang, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lines.setdefault(lang, []).append(line)
            for lang, own in lines.items():
                units = np.frombuffer("".join(own).encode("utf-16-le"), "<u2").astype(np.int64)
                ends = np.cumsum([len(line) for line in own])
                whole = np.ones(len(units), dtype=bool)  # a run that begins here ends in the same text
                whole[ends - 1] = whole[ends - 2] = False
                code, n = np.unique(((units[:-2] << 32) | (units[1:-1] << 16) | units[2:])[whole[:-2]], return_counts=True)
                if not len(code):
                    continue
                text = np.stack([code >> 32, (code >> 16) & 0xFFFF, code & 0xFFFF], axis=1).astype("<u2").tobytes().decode("utf-16-le")
                grams = [text[i : i + 3] for i in range(0, len(text), 3)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    small_batches(labelled.sparkSession)
    lines = labelled.select("lang", _line(F.col("text")).alias("line"))
    return lines.mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn_profiles(labelled: DataFrame, text: str = "text", lang: str = "lang", size: int = SIZE) -> DataFrame:
    """(lang, gram, weight, base): the ``size`` commonest trigrams of every language in ``labelled``.

    Of equally common trigrams the first in the alphabet counts; rows without a language or text
    teach nothing.
    """
    known = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = count_trigrams(known.select(F.col(lang).alias("lang"), F.col(text).alias("text")))
    counts, _ = StagingArea(labelled.sparkSession, "profiles").write(counts, "counts")
    kinds = counts.agg(F.count_distinct("gram")).first()[0]
    totals = counts.groupBy(F.col("lang").alias("_lang")).agg(F.sum("n").alias("_total"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("_place", place).where(F.col("_place") <= size)
    scaled = lambda c: F.round(MILLION * F.log(c)).cast("bigint")
    return (
        top.join(totals, F.col("lang") == F.col("_lang"))
        .select("lang", "gram", scaled((F.col("n") + 1).cast("double")).alias("weight"), (-scaled((F.col("_total") + kinds).cast("double"))).alias("base"))
    )


def detect_by_profiles(docs: DataFrame, profiles: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, detected, score): the likeliest of the languages that know a trigram of the text.

    NULL where none does; of equally likely languages the first by name. ``score`` is the
    log-likelihood per trigram in millionths. ``key`` tells texts apart.
    """
    grams = trigrams(F.coalesce(F.col(text), F.lit("")))
    # counted before they are exploded: beside explode, the whole text would be cut anew for every row
    cut = docs.select(F.col(key), grams.alias("_cut")).withColumn("_grams", F.size("_cut"))
    rows = cut.select(key, "_grams", F.explode_outer("_cut").alias("gram"))
    sums = (
        rows.join(broadcast_if_small(profiles, 100_000), "gram", "left")
        .groupBy(key, "lang").agg(F.sum("weight").alias("weight"), F.max("base").alias("base"), F.max("_grams").alias("_grams"))
    )
    score = F.col("weight") + F.col("_grams") * F.col("base")
    found = F.when(F.col("lang").isNotNull(), F.struct((-score).alias("cost"), F.col("lang").alias("lang"), F.col("_grams").alias("grams")))
    return sums.groupBy(key).agg(F.min(found).alias("_best")).select(
        key, F.col("_best.lang").alias("detected"), F.expr("-_best.cost div _best.grams").alias("score")
    )


def accuracy(found: DataFrame, truth: DataFrame, key: str = "doc_id", lang: str = "lang") -> DataFrame:
    """(truth, detected, n) over the texts of ``truth``."""
    both = truth.select(key, F.col(lang).alias("truth")).join(found.select(key, F.coalesce("detected", F.lit("none")).alias("detected")), key)
    return both.groupBy("truth", "detected").agg(F.count(F.lit(1)).alias("n"))
