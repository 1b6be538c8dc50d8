"""Quality rules (10): cross-document line frequency, on built-in functions only.

Lines are normalised (case and runs of white space do not count, and in a line with letters neither
does which number stands alone between spaces; digits inside words and lines of numbers stay) and hashed. A line that
stands in more distinct documents of one host than the host's limit is boilerplate and is
removed; copies of one text count as one document, so copying a text does not make its lines
boilerplate. A document is rejected if it fails the base rules or if too few of its words are
left. Documents carry no host name of their own, so the query takes ``source`` for it.

Limit of a host: ``min_docs`` documents, or ``max_share`` of its distinct documents if that is
more. A host therefore has at most (lines per document / max_share) boilerplate lines, which
bounds the list each of its documents is compared with.

Defined results: a NULL or empty text has no words and fails the base rules; a NULL host is a
host of its own; repeated rows are judged alike; an empty table gives no rows; columns with
clashing names are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archiveloom.llm.names import unused
from archiveloom.staging import StagingArea

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 3


@dataclass(frozen=True)
class Limits:
    min_words: int = 50
    max_repeat_percent: int = 50
    min_docs: int = 20
    max_share: float = 0.05
    min_left: float = 0.3  # share of words that must stay


LETTER = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]"  # ASCII letters and everything beyond ASCII


def normalised(line: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(line), r"[\x20\x09-\x0D]+", " "))
    numberless = F.regexp_replace(plain, "(^| )[0-9]+(?= |$)", "$10")  # group 1 and a 0
    return F.when(plain.rlike("[0-9]") & plain.rlike(LETTER), numberless).otherwise(plain)


def base_counts(text: str) -> dict[str, Column]:
    """Counts over the whole text; ``words`` must exist as a column (see :func:`measured`)."""
    kept = F.length(F.translate(text, SPACES, ""))
    return {
        "n_words": F.size("words").cast("long"),
        "word_chars": kept.cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
    }


def repeat_words(docs: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words that lie in a 3-word window found twice or more.

    Windows are hashed and sorted with their places; only texts in which a hash repeats get so
    far. Neighbours of equal hash are repeats, and their places, sorted again, cover
    min(3, distance to the next place) words each.
    """
    last = F.size("words") - WINDOW
    at = lambda i: F.xxhash64(*[F.get("words", i + j) for j in range(WINDOW)])
    hashes = F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), at))
    twice = F.size("_hashes") > F.size(F.array_distinct("_hashes"))
    hash_at = lambda i: F.get("_sorted", i)["h"]
    places = F.transform(
        F.filter("_sorted", lambda x, j: (x["h"] == hash_at(j - 1)) | (x["h"] == hash_at(j + 1))), lambda x: x["i"]
    )
    steps = F.transform("_places", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get("_places", j + 1) - p, F.lit(WINDOW))))
    return (
        docs.withColumn("_hashes", hashes)
        .withColumn("_sorted", F.when(twice, F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
        .withColumn("_places", F.sort_array(places))
        .withColumn("n_repeat_words", F.coalesce(F.aggregate(steps, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long"))
        .drop("_hashes", "_sorted", "_places", "words")
    )


def measured(docs: DataFrame, id: str, host: str, text: str) -> DataFrame:
    """(id, host, text_hash, counts, lines) of every document; ``lines`` are (h, words)."""
    plain = docs.select(F.col(id).alias("id"), F.col(host).alias("host"), F.coalesce(text, F.lit("")).alias("text"))
    with_words = plain.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), 0)).withColumn(
        "_lines", F.filter(F.split("text", "\n"), lambda l: l.rlike(WORD))
    )
    lines = F.transform("_lines", lambda l: F.struct(F.xxhash64(normalised(l)).alias("h"), F.regexp_count(l, F.lit(WORD)).alias("words")))
    counted = with_words.select(
        "id", "host", F.xxhash64("text").alias("text_hash"), "words", lines.alias("lines"),
        *[c.alias(n) for n, c in base_counts("text").items()],
    )
    return repeat_words(counted)


def boilerplate(measures: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(host, h, n_docs) of lines over their host's limit."""
    texts = measures.groupBy("host", "text_hash").agg(F.any_value("lines").alias("lines"))
    sizes = texts.groupBy(F.col("host").alias("_host")).agg(F.count(F.lit(1)).alias("_size"))
    found = (
        texts.select("host", F.explode(F.array_distinct(F.transform("lines", lambda l: l["h"]))).alias("h"))
        .groupBy("host", "h").agg(F.count(F.lit(1)).alias("n_docs"))
        .where(F.col("n_docs") > limits.min_docs)
    )
    limit = F.greatest(F.lit(float(limits.min_docs)), limits.max_share * F.col("_size"))
    return found.join(sizes, F.col("host").eqNullSafe(F.col("_host"))).where(F.col("n_docs") > limit).select("host", "h", "n_docs")


def judge(docs: DataFrame, limits: Limits = Limits(), id: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """Counts, ``base_failed``, ``n_left_words`` and ``kept`` of every document.

    Texts are read once; measures (hashes and counts) are staged and everything else, the count
    of lines and the join with the boilerplate lists, works on them.
    """
    staging = StagingArea(docs.sparkSession, "lines")
    measures, _ = staging.write(measured(docs, id, host, text), "measures")
    lists = boilerplate(measures, limits).groupBy(F.col("host").alias("_host")).agg(F.collect_list("h").alias("_listed"))
    left = F.aggregate(
        "lines", F.lit(0).cast("long"),
        lambda n, l: n + F.when(F.array_contains(F.col("_listed"), l["h"]), 0).otherwise(l["words"]),
    )
    failed = (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words"))
    return (
        measures.join(lists, F.col("host").eqNullSafe(F.col("_host")), "left")
        .withColumn("n_left_words", F.when(F.col("_listed").isNull(), F.col("n_words")).otherwise(left))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("n_left_words") >= limits.min_left * F.col("n_words")))
        .select(
            F.col("id").alias(id), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "base_failed", "n_left_words", "kept",
        )
    )


def without_lines(docs: DataFrame, listed: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """``docs`` with the lines of ``listed`` (see :func:`boilerplate`) taken out of their texts."""
    to, gone = unused(docs, "_host", "_listed")
    lists = listed.groupBy(F.col("host").alias(to)).agg(F.collect_list("h").alias(gone))
    rest = F.filter(F.split(text, "\n"), lambda l: ~(l.rlike(WORD) & F.array_contains(F.col(gone), F.xxhash64(normalised(l)))))
    cleaned = F.when(F.col(gone).isNull(), F.col(text)).otherwise(F.array_join(rest, "\n"))
    joined = docs.join(lists, F.col(host).eqNullSafe(F.col(to)), "left")
    return joined.withColumn(text, cleaned).drop(to, gone)
