"""Classification of projects and files against the taxonomy."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archiveloom.functions.text import blank_to_null, strip
from archiveloom.operators.keywords import nearest_tags, tag_arrays
from archiveloom.operators.project_type import file_candidates
from archiveloom.operators.skew import broadcast_if_small
from archiveloom.operators.vectors import Embedder, hashed_embedder, nearest_two, sum_vectors

# Fragments of one id range that are put in order together, before the ranges are. At most 4096, as a
# place in a range is written in two characters.
RANGE_IDS = 1 << 12


def division_label() -> Column:
    """``{section}{code} - {code} - {title}``."""
    return F.concat("section", "code", F.lit(" - "), "code", F.lit(" - "), "title")


def division_corpus(divisions: DataFrame, sections: DataFrame) -> DataFrame:
    """(idx, section, code, title, label, text): what each division is matched by."""
    return divisions.join(sections, "section").select(
        "idx", "section", "code", "title",
        division_label().alias("label"),
        F.concat("section_title", F.lit(". "), "title").alias("text"),
    )


def project_fragments(projects: DataFrame, keywords: DataFrame, files: DataFrame) -> DataFrame:
    """(project_id, kind, seq, text): title, description, keywords, file names, in order.

    NULL and empty values are left out.
    """
    def rows(df: DataFrame, key: str, kind: int, seq: Column, text: str) -> DataFrame:
        return df.select(
            F.col(key).alias("project_id"), F.lit(kind).alias("kind"),
            seq.cast("bigint").alias("seq"), F.col(text).alias("text"),
        )

    parts = [
        rows(projects, "id", 1, F.lit(0), "title"),
        rows(projects, "id", 2, F.lit(0), "description"),
        rows(keywords, "project_id", 3, F.col("id"), "keyword"),
        rows(files, "project_id", 4, F.col("id"), "file_name"),
    ]
    return reduce(DataFrame.union, parts).where(F.col("text") != "")


def _in_order(item: Column, text: str) -> Column:
    sorted_items = F.array_sort(F.collect_list(item))
    return F.array_join(F.transform(sorted_items, lambda i: i[text]), " ")


def project_text(fragments: DataFrame) -> DataFrame:
    """(project_id, text): fragments joined by one blank, in order, and trimmed.

    Ranges of ids are put together first, in many tasks for a large project, and then the
    ranges: a project is one text whatever its size, and sorting is spread. Within a range a
    fragment goes as one string, two characters that sort like its place and then its text.
    """
    start = F.expr(f"seq div {RANGE_IDS} - if(seq % {RANGE_IDS} < 0, 1, 0)")
    block = F.shiftleft(F.col("kind").cast("bigint"), 52) + start
    # rows without a place are a range of their own
    place = F.coalesce(F.pmod("seq", F.lit(RANGE_IDS)), F.lit(0))
    digit = lambda d: F.char(d + 32)
    placed = F.concat(digit(F.shiftright(place, 6)), digit(place.bitwiseAND(F.lit(63))), F.col("text"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(placed)), lambda t: F.substr(t, F.lit(3))), " ")
    blocks = fragments.groupBy("project_id", block.alias("block")).agg(joined.alias("text"))
    return blocks.groupBy("project_id").agg(strip(_in_order(F.struct("block", "text"), "text")).alias("text"))


def embedded_corpus(corpus: DataFrame, embedder: Embedder | None = None) -> DataFrame:
    embedder = embedder or hashed_embedder()
    return corpus.withColumn("vector", embedder(F.col("text")))


def _labelled(df: DataFrame, corpus: DataFrame, primary: str, secondary: str) -> DataFrame:
    """Replace ``first``/``second`` by the labels of the divisions they point to."""
    labels = broadcast_if_small(corpus.select("idx", "label"))
    for index, name in (("first", primary), ("second", secondary)):
        named = labels.select(F.col("idx").alias(index), F.col("label").alias(name))
        df = df.join(named, index, "left").drop(index)
    return df


def project_vectors(fragments: DataFrame, embedder: Embedder | None = None) -> DataFrame:
    """(project_id, vector) of all texts of a project.

    The default bag of words is summed over the fragments, which equals the vector of the
    whole text; another embedder sees the whole text.
    """
    if embedder is None:
        return sum_vectors(fragments, "project_id")
    return project_text(fragments).select("project_id", embedder(F.col("text")).cast("array<double>").alias("vector"))


def classify_projects(
    fragments: DataFrame, corpus: DataFrame, embedder: Embedder | None = None, vectors: DataFrame | None = None
) -> DataFrame:
    """(project_id, primary_class, secondary_class, scores) from all texts of a project.

    A project without any text has no row here and keeps NULL classes. ``vectors`` are
    :func:`project_vectors`, if the caller has them.
    """
    vectors = project_vectors(fragments, embedder) if vectors is None else vectors
    found = nearest_two(vectors, "vector", embedded_corpus(corpus, embedder)).drop("vector")
    return _labelled(found, corpus, "primary_class", "secondary_class")


def classify_texts(
    df: DataFrame, text: str, corpus: DataFrame, embedder: Embedder | None = None
) -> DataFrame:
    """Adds ``primary_class`` and ``secondary_class`` by the text of each row.

    Rows with no text get NULLs.
    """
    embedder = embedder or hashed_embedder()
    embedded = df.withColumn("_vector", embedder(F.col(text))).withColumn(
        "_vector", F.when(blank_to_null(strip(text)).isNotNull(), F.col("_vector"))
    )
    found = nearest_two(embedded, "_vector", embedded_corpus(corpus, embedder)).drop("_vector")
    return _labelled(found, corpus, "primary_class", "secondary_class")


def classify_files(
    files: DataFrame, projects: DataFrame, corpus: DataFrame, embedder: Embedder | None = None
) -> DataFrame:
    """(file_id, primary_class, secondary_class, by_name) of the primary data files.

    A file is classified by the words of its name, or takes the classes of its project when
    the name has fewer than two.
    """
    named = file_candidates(files, projects).withColumn(
        "_text", F.when(F.col("by_name"), F.col("text"))
    )
    found = classify_texts(named, "_text", corpus, embedder)
    choose = lambda own, inherited: F.when(F.col("by_name"), F.col(own)).otherwise(F.col(inherited))
    return found.select(
        "file_id", "project_id", "by_name",
        choose("primary_class", "project_primary").alias("primary_class"),
        choose("secondary_class", "project_secondary").alias("secondary_class"),
    )


def classify(archive_projects: DataFrame, keywords: DataFrame, files: DataFrame, corpus: DataFrame,
             scope: str = "all", embedder: Embedder | None = None) -> tuple[DataFrame, DataFrame]:
    """Projects and files with their class columns; ``scope`` is projects, files or all.

    Projects also get their tags, the words nearest to them by the same embedder, and an empty
    list when they have no text.
    """
    if scope not in ("projects", "files", "all"):
        raise ValueError(f"scope {scope!r}: expected projects, files or all")
    projects = archive_projects
    if scope in ("projects", "all"):
        fragments = project_fragments(projects, keywords, files)
        vectors = project_vectors(fragments, embedder)
        found = classify_projects(fragments, corpus, embedder, vectors).select(
            F.col("project_id").alias("id"), "primary_class", "secondary_class"
        )
        nearest = nearest_tags(fragments, "project_id", vectors, embedder)
        tags = tag_arrays(nearest, "project_id").withColumnRenamed("project_id", "id")
        projects = (
            projects.drop("primary_class", "secondary_class", "tags")
            .join(found, "id", "left")
            .join(tags, "id", "left")
            .withColumn("tags", F.coalesce("tags", F.array().cast("array<string>")))
        )
    if scope in ("files", "all"):
        found = classify_files(files, projects, corpus, embedder).select(
            F.col("file_id").alias("id"), "primary_class", "secondary_class"
        )
        files = files.drop("primary_class", "secondary_class").join(found, "id", "left")
    return projects, files
