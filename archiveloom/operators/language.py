"""Language of a text by its function words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Common function words per language
FUNCTION_WORDS = {
    "de": ("der", "die", "das", "und", "ist", "nicht", "mit", "den", "von", "ein", "eine", "zu", "auf", "für"),
    "en": ("the", "and", "of", "to", "is", "that", "for", "with", "are", "was", "this", "be", "on", "as"),
    "es": ("el", "los", "las", "que", "y", "con", "una", "por", "para", "del", "se", "su", "como", "más"),
    "fr": ("le", "les", "et", "des", "une", "est", "que", "dans", "pour", "qui", "avec", "du", "au", "sur"),
}


def language_votes(text: Column, vocabularies: dict[str, tuple[str, ...]] | None = None) -> Column:
    """array<struct<votes, rank, lang>>: how many words of a text each language claims.

    Row-local: the whole text is read where it lies and nothing is shuffled. One regular
    expression per language counts its words between characters that are no letter or
    digit, which is several times faster than splitting the text and testing each word.
    """
    votes = []
    for rank, (lang, vocabulary) in enumerate(sorted((vocabularies or FUNCTION_WORDS).items())):
        pattern = rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(vocabulary)})(?![\p{{L}}\p{{N}}])"
        hits = F.regexp_count(F.lower(text), F.lit(pattern))
        # a lower rank wins a tie, hence the minus
        votes.append(
            F.struct(hits.alias("votes"), F.lit(-rank).alias("rank"), F.lit(lang).alias("lang"))
        )
    return F.array(*votes)


def detect_language(text: Column, vocabularies: dict[str, tuple[str, ...]] | None = None) -> Column:
    """Language with the most function words; NULL when the text has none of any.

    ``vocabularies`` gives the words per language where the four built-in ones do not do.
    """
    best = F.array_max(language_votes(text, vocabularies))
    return F.when(best["votes"] > 0, best["lang"])


def language_or_detected(declared: Column, text: Column) -> Column:
    """The declared language if there is one, else the detected one."""
    return F.coalesce(F.nullif(declared, F.lit("")), detect_language(text))


def detection_accuracy(df: DataFrame, text: str, truth: str) -> DataFrame:
    """(truth, detected, n): confusion table."""
    found = F.coalesce(detect_language(F.col(text)), F.lit("none"))
    return df.groupBy(F.col(truth).alias("truth"), found.alias("detected")).agg(
        F.count(F.lit(1)).alias("n")
    )
