"""Reporting datasets: what the charts, tables and findings of the archive show."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archiveloom import dimensions as dim
from archiveloom.functions.text import shorten, slug
from archiveloom.operators import counts as c
from archiveloom.operators import ranks as r
from archiveloom.sources.sinks import write_csv, write_findings


# Sentences of the findings documents
NARRATIVE = (
    "The %s repository contributes %d projects to the aggregated dataset. "
    "Of these, %.1f%% were identified as QD projects and %.1f%% as QDA projects, with "
    "%.1f%% classified as other data and %.1f%% as non-project entries. "
    "Across %d distinct ISIC divisions, the most frequent primary class is %s, "
    "accounting for %.1f%% of the repository's projects."
)
FINDINGS_TITLE = "# Findings: "
FACTS_TITLE = "## Key facts"
TOTAL_LINE = "- Total projects: %d"
CLASSES_LINE = "- Distinct primary classes observed: %d"
TOP_LINE = "- Most common primary class: %s (%d projects, %.1f%%)"
UNCLASSIFIED_LINE = "- Unclassified projects (no primary_class): %d (%.1f%%)"
TYPES_TITLE = "## Projects by type"


def _percent(part: str, total: str = "total") -> Column:
    return r.share(F.col(part), F.col(total))


def repo_key_facts(cube: DataFrame) -> DataFrame:
    """(repository, total, classes, unclassified, top_label, top_n) and their shares."""
    by_class = c.repo_class_counts(cube)
    unclassified = F.coalesce(
        F.sum(F.when(F.col("primary_class") == dim.UNCLASSIFIED, F.col("n"))), F.lit(0)
    )
    best = F.struct(F.col("n"), -F.col("first_id"))
    return (
        by_class.groupBy("repository")
        .agg(
            F.sum("n").alias("total"),
            F.count(F.lit(1)).alias("classes"),
            unclassified.cast("bigint").alias("unclassified"),
            F.max_by("primary_class", best).alias("top_label"),
            F.max("n").alias("top_n"),
        )
        .withColumn("top_share", _percent("top_n"))
        .withColumn("unclassified_share", _percent("unclassified"))
    )


def repo_type_shares(cube: DataFrame) -> DataFrame:
    """Four type counts and shares per repository."""
    wide = c.repo_type_pivot(cube)
    return wide.withColumns({f"{t}_share": _percent(t) for t in ("qda", "qd", "other", "no_project")})


def repo_narrative(cube: DataFrame) -> DataFrame:
    """Numbers and text of a repository's summary, one row per repository."""
    facts = repo_key_facts(cube).join(repo_type_shares(cube).drop("total"), "repository")
    text = F.format_string(
        NARRATIVE, "repository", "total", "qd_share", "qda_share", "other_share", "no_project_share",
        "classes", "top_label", "top_share",
    )
    return facts.withColumn("narrative", text)


def repo_findings(cube: DataFrame) -> DataFrame:
    """(repository, line_no, fact, label, n, share): the findings list in reading order.

    The unclassified line is there only when it counts something.
    """
    facts = repo_narrative(cube)
    none = F.lit(None).cast("double")
    line = lambda no, fact, label, n, share: F.struct(
        F.lit(no).cast("bigint").alias("line_no"), F.lit(fact).alias("fact"), label.alias("label"),
        n.cast("bigint").alias("n"), share.alias("share"),
    )
    empty = F.lit("")
    lines = [
        line(1, "total projects", empty, F.col("total"), none),
        line(2, "distinct primary classes", empty, F.col("classes"), none),
        line(3, "most common primary class", F.col("top_label"), F.col("top_n"), F.col("top_share")),
        line(4, "unclassified projects", empty, F.col("unclassified"), F.col("unclassified_share")),
    ]
    for no, (column, (_, label)) in enumerate(zip(("qda", "qd", "other", "no_project"), dim.TYPE_LABELS), 5):
        lines.append(line(no, "type", F.lit(label), F.col(column), F.col(f"{column}_share")))
    return facts.select("repository", F.inline(F.array(*lines))).where(
        (F.col("fact") != "unclassified projects") | (F.col("n") > 0)
    )


def findings_text(cube: DataFrame) -> DataFrame:
    """(repository, slug, value): the findings document of each repository."""
    f = repo_narrative(cube)
    top = F.format_string(TOP_LINE, "top_label", "top_n", "top_share")
    unclassified = F.when(
        F.col("unclassified") > 0,
        F.format_string(UNCLASSIFIED_LINE, "unclassified", "unclassified_share"),
    )
    types = [
        F.format_string(f"- {label}: %d (%.1f%%)", column, f"{column}_share")
        for column, (_, label) in zip(("qda", "qd", "other", "no_project"), dim.TYPE_LABELS)
    ]
    value = F.concat_ws(
        "\n",
        F.concat(F.lit(FINDINGS_TITLE), "repository"), F.lit(""), F.col("narrative"), F.lit(""),
        F.lit(FACTS_TITLE), F.lit(""),
        F.format_string(TOTAL_LINE, "total"), F.format_string(CLASSES_LINE, "classes"),
        top, unclassified, F.lit(""), F.lit(TYPES_TITLE), F.lit(""), *types,
    )
    return f.select("repository", slug("repository").alias("slug"), value.alias("value"))


def scoped_counts(cube: DataFrame) -> DataFrame:
    """(repository, scope, primary_class, n, first_id) for scopes all, qda and qd."""
    whole = c.repo_class_counts(cube).withColumn("scope", F.lit("all"))
    scope = F.create_map(*[F.lit(v) for s, t in dim.REPORT_SCOPES for v in (t, s)])
    typed = cube.withColumn("scope", F.try_element_at(scope, F.col("type"))).where(
        F.col("scope").isNotNull()
    )
    return whole.unionByName(typed.drop("type"))


def rank_tables(cube: DataFrame) -> DataFrame:
    """(repository, scope, rank, primary_class, n): top 20; an empty scope has no rows."""
    ranked = r.rank_table(scoped_counts(cube), ["repository", "scope"])
    return ranked.select("repository", "scope", "rank", "primary_class", "n")


def file_rank_tables(file_counts: DataFrame, top_n: int = r.FILE_TABLE_ROWS) -> DataFrame:
    """(repository, scope, rank, primary_class, n) of classified files."""
    return r.rank_table(file_counts, ["repository"], top_n).select(
        "repository", F.lit("files").alias("scope"), "rank", "primary_class", "n"
    )


def histograms(cube: DataFrame, file_counts: DataFrame) -> DataFrame:
    """Top-20 bars per repository for all, QDA, QD and files, drawn from the bottom up."""
    bars = rank_tables(cube).unionByName(file_rank_tables(file_counts, r.TABLE_ROWS))
    return bars.withColumn("label", shorten("primary_class"))


def repo_pies(cube: DataFrame) -> DataFrame:
    """(repository, pie, slice, label, n, share): class fold and type donut, no empty slices."""
    classes = r.fold_into_other(c.repo_class_counts(cube), ["repository"], "primary_class")
    by_class = r.nonzero(classes).select(
        "repository", F.lit("class").alias("pie"), "slice",
        shorten("primary_class").alias("label"), "n",
    )
    return r.with_share(by_class.unionByName(type_donut(cube)), ["repository", "pie"])


def type_donut(cube: DataFrame) -> DataFrame:
    """(repository, pie, slice, label, n): the four types in descending size, ties in report order."""
    wide = c.repo_type_pivot(cube)
    slots = F.array(
        *[
            F.struct((-F.col(column)).alias("minus_n"), F.lit(i).alias("place"), F.lit(label).alias("label"))
            for i, (column, (_, label)) in enumerate(zip(("qda", "qd", "other", "no_project"), dim.TYPE_LABELS))
        ]
    )
    return (
        wide.select("repository", F.posexplode(F.array_sort(slots)).alias("pos", "slot"))
        .select(
            "repository", F.lit("type").alias("pie"), (F.col("pos") + 1).cast("bigint").alias("slice"),
            F.col("slot.label").alias("label"), (-F.col("slot.minus_n")).alias("n"),
        )
        .where("n > 0")
    )


def archive_series(projects: DataFrame, repositories: DataFrame) -> DataFrame:
    """(series, slice, label, n): archive-wide folds by repository, type and class."""
    by_repo = c.count_by_repository(projects, repositories).select(
        F.lit("repository").alias("series"), F.col("repository").alias("label"), "n",
        F.coalesce(F.format_string("%020d", "tie"), F.lit("")).alias("tie"),
    )
    by_type = c.count_by_type(projects).select(
        F.lit("type").alias("series"), "label", "n", _group_key("label").alias("tie")
    )
    by_class = c.count_by_class(projects).select(
        F.col("column_name").alias("series"), "label", "n", _group_key("label").alias("tie")
    )
    folded = r.fold_into_other(by_repo.unionByName(by_class), ["series"], "label", tie="tie")
    types = r.fold_into_other(by_type, ["series"], "label", len(dim.PROJECT_TYPES), tie="tie")
    return folded.unionByName(types)


def _group_key(label: str) -> Column:
    """The grouping value behind a label: a missing one sorts first."""
    return F.when(F.col(label) == dim.UNCLASSIFIED, F.lit("")).otherwise(F.col(label))


def repo_report(projects: DataFrame, files: DataFrame, repositories: DataFrame) -> dict[str, DataFrame]:
    """Every dataset of the per-repository report, from one pass over projects and one over files."""
    cube = c.class_cube(projects, repositories)
    file_counts = c.repo_file_class_counts(projects, files, repositories)
    return {
        "rank_tables": rank_tables(cube),
        "file_rank_tables": file_rank_tables(file_counts),
        "histograms": histograms(cube, file_counts),
        "pies": repo_pies(cube),
        "findings": repo_findings(cube),
        "findings_text": findings_text(cube),
    }


def write_repo_report(report: dict[str, DataFrame], path: str) -> None:
    """Rank tables as CSV per repository and scope, findings as one text per repository."""
    tables = report["rank_tables"].unionByName(report["file_rank_tables"])
    write_csv(
        tables.select("rank", "primary_class", F.col("n").alias("count"), slug("repository").alias("slug"), "scope"),
        f"{path}/rank_tables", ["slug", "scope"],
    )
    write_findings(report["findings_text"], f"{path}/findings")


# Blocks of a report section, in order (block, scope)
REPORT_BLOCKS = (
    ("overview", "all"), ("histogram", "all"), ("histogram", "qda"), ("histogram", "qd"),
    ("table", "all"), ("table", "qda"), ("table", "qd"), ("histogram", "files"), ("table", "files"),
)


def report_blocks(
    tables: DataFrame, file_tables: DataFrame, file_bars: DataFrame, sections: DataFrame
) -> DataFrame:
    """(section_no, section_title, block_no, block, scope, rank, primary_class, n).

    One row per shown line of every section, in the order of the written report. A scope
    without projects keeps one empty histogram row and has no table.
    """
    bars = tables.unionByName(file_bars).withColumn("block", F.lit("histogram"))
    ranked = tables.unionByName(file_tables).withColumn("block", F.lit("table"))
    lines = bars.unionByName(ranked).select(
        slug("repository").alias("slug"), "block", "scope", "rank", "primary_class", "n"
    )
    blocks = F.array(
        *[
            F.struct(F.lit(i).cast("bigint").alias("block_no"), F.lit(b).alias("block"), F.lit(s).alias("scope"))
            for i, (b, s) in enumerate(REPORT_BLOCKS, 1)
        ]
    )
    outline = sections.select("*", F.inline(blocks))
    shown = (
        (F.col("block") == "overview")
        | ((F.col("block") == "histogram") & (F.col("scope") != "files"))
        | F.col("rank").isNotNull()
    )
    return (
        outline.join(lines, ["slug", "block", "scope"], "left")
        .where(shown)
        .select("section_no", "section_title", "block_no", "block", "scope", "rank", "primary_class", "n")
    )
