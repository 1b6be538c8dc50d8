"""Ranks, folds, shares and report blocks on small archives."""

from archiveloom import dimensions as dim
from archiveloom.operators import counts as ct
from archiveloom.operators import ranks as rk
from archiveloom.plans import report as rp
from archiveloom.sources import sinks
from archiveloom.staging import StagingArea
from conftest import rows

SCHEMA = "id long, repository_id long, type string, primary_class string, secondary_class string"


def archive(spark):
    data, i = [], 0
    # repository 1: 25 classes with counts 1..25, all QD but one; repository 5: three projects
    for k in range(1, 26):
        for _ in range(k):
            i += 1
            data.append((i, 1, "QD_PROJECT" if k > 1 else None, f"class {k:02d}", None))
    data += [(1000, 5, "QDA_PROJECT", "b", ""), (1001, 5, "OTHER_PROJECT", "a", "s"), (1002, 5, "odd", None, "s")]
    data += [(1003, 77, "QD_PROJECT", "", None)]
    return spark.createDataFrame(data, SCHEMA)


def cube(spark):
    return ct.class_cube(archive(spark), dim.repositories_table(spark)).cache()


def test_counts_sum_to_the_total(spark):
    df, c = archive(spark), cube(spark)
    total = df.count()
    repos = dim.repositories_table(spark)
    for counted in (ct.count_by_repository(df, repos), ct.count_by_type(df), ct.repo_class_counts(c), ct.repo_type_counts(c)):
        assert sum(r.n for r in counted.collect()) == total
    assert dict(rows(ct.count_by_type(df)))["odd"] == 1 and dict(rows(ct.count_by_type(df)))["UNCLASSIFIED"] == 1
    types = {(r.repository, r.type_label): r.n for r in ct.repo_type_counts(c).collect()}
    assert types[("dans", "No project")] == 1 and types[("zenodo", "No project")] == 1
    assert ("unknown (77)", "QD") in types


def test_rollup_marks_levels_and_keeps_null_types(spark):
    got = rows(ct.repo_rollup(cube(spark)).where("repository = 'zenodo' and grouping = 'type'").select("type", "n"))
    assert got == [("QD_PROJECT", 324), (None, 1)]


def test_rank_tables(spark):
    c = cube(spark)
    got = rows(rp.rank_tables(c).where("repository = 'zenodo' and scope = 'all'").select("rank", "primary_class", "n"))
    assert got[0] == (1, "class 25", 25) and got[-1] == (20, "class 06", 6) and len(got) == 20
    # equal counts: the class of the smallest project id comes first
    dans = rows(rp.rank_tables(c).where("repository = 'dans' and scope = 'all'").select("rank", "primary_class"))
    assert dans == [(1, "b"), (2, "a"), (3, "UNCLASSIFIED")]
    scopes = {r.scope for r in rp.rank_tables(c).where("repository = 'zenodo'").collect()}
    assert scopes == {"all", "qd"}


def test_fold_preserves_the_sum(spark):
    by_class = ct.repo_class_counts(cube(spark))
    folded = rk.fold_into_other(by_class, ["repository"], "primary_class")
    got = rows(folded.where("repository = 'zenodo'").select("slice", "primary_class", "n"))
    assert len(got) == 8 and got[-1] == (8, "Other", sum(range(1, 19))) and sum(r[2] for r in got) == 325
    assert folded.where("repository = 'dans'").count() == 3
    shares = {}
    for r in rk.with_share(folded, ["repository"]).collect():
        shares[r.repository] = shares.get(r.repository, 0) + r.share
    assert all(abs(s - 100) < 1e-9 for s in shares.values())


def test_fold_at_the_limit_has_no_other(spark):
    counts = spark.createDataFrame([("r", f"l{i}", 5, i) for i in range(8)], "g string, label string, n long, first_id long")
    assert rk.fold_into_other(counts.where("first_id < 7"), ["g"], "label").count() == 7
    assert rows(rk.fold_into_other(counts, ["g"], "label").where("slice = 8").select("label", "n")) == [("Other", 5)]


def test_bars_ascend_with_ties_by_key(spark):
    counts = spark.createDataFrame([("x", 2, 3), ("y", 1, None), ("z", 1, 1)], "label string, n long, tie long")
    got = sorted((r.position, r.label) for r in rk.bar_series(counts, "label", StagingArea(spark, "t")).collect())
    assert got == [(1, "y"), (2, "z"), (3, "x")]


def test_narrative_and_findings(spark):
    c = cube(spark)
    text = {r.repository: r.value for r in rp.findings_text(c).collect()}
    assert "contributes 325 projects" in text["zenodo"] and "- QD: 324 (99.7%)" in text["zenodo"]
    assert "Unclassified projects" not in text["zenodo"]
    assert "- Unclassified projects (no primary_class): 1 (33.3%)" in text["dans"]
    assert text["dans"].splitlines()[0] == "# Findings: dans"
    lines = rows(rp.repo_findings(c).where("repository = 'dans'").select("line_no", "label", "n"))
    assert [l[0] for l in lines] == list(range(1, 9)) and lines[2] == (3, "b", 1)


def test_report_blocks(spark):
    c = cube(spark)
    empty = spark.createDataFrame([], "repository string, primary_class string, n long, first_id long")
    files = rp.file_rank_tables(empty)
    blocks = rp.report_blocks(rp.rank_tables(c), files, files, dim.report_sections_table(spark)).collect()
    assert {b.section_no for b in blocks} == set(range(1, 20))
    zenodo = [b for b in blocks if b.section_title == "Zenodo"]
    # no QDA project: one empty histogram line and no table; no file block at all
    assert [(b.block, b.rank) for b in zenodo if b.scope == "qda"] == [("histogram", None)]
    assert sum(b.block == "table" and b.scope == "qd" for b in zenodo) == 20
    assert not [b for b in blocks if b.scope == "files"]


def test_sinks_of_rank_tables_and_findings(spark, tmp_path):
    from archiveloom.functions.text import slug

    c = cube(spark)
    tables = rp.rank_tables(c).select(
        "rank", "primary_class", "n", slug("repository").alias("slug"), "scope"
    ).withColumnRenamed("n", "count")
    sinks.write_csv(tables, f"{tmp_path}/ranks", ["slug", "scope"])
    back = sinks.read_rank_tables(spark, f"{tmp_path}/ranks")
    assert rows(back.select(*tables.columns)) == rows(tables)
    sinks.write_findings(rp.findings_text(c), f"{tmp_path}/findings")
    assert (tmp_path / "findings" / "slug=dans").exists()


# Published totals of the nineteen repositories: projects, QDA, QD, other, none
PUBLISHED = (
    (51426, 68, 27095, 22967, 1296), (12921, 71, 6915, 5625, 310), (6973, 22, 5450, 1496, 5),
    (4652, 35, 2728, 1318, 571), (3372, 0, 979, 32, 2361), (2969, 0, 58, 868, 2043), (1530, 4, 430, 53, 1043),
    (1286, 43, 1108, 120, 15), (950, 0, 13, 937, 0), (648, 0, 647, 1, 0), (530, 1, 140, 167, 222),
    (472, 45, 284, 143, 0), (422, 39, 265, 87, 31), (414, 0, 103, 311, 0), (327, 2, 325, 0, 0),
    (322, 0, 296, 22, 4), (225, 0, 223, 2, 0), (125, 8, 64, 53, 0), (94, 0, 89, 2, 3),
)


def test_published_totals_add_up_through_the_report(spark):
    """The published counts, fed in as projects, come out of the type report unchanged."""
    types = ("QDA_PROJECT", "QD_PROJECT", "OTHER_PROJECT", "NOT_A_PROJECT")
    repos = [i for i in range(1, 21) if i != 14]
    plan = [(repo, t, n) for repo, row in zip(repos, PUBLISHED) for t, n in zip(types, row[1:])]
    df = spark.createDataFrame(plan, "repository_id long, type string, n int").where("n > 0").selectExpr(
        "repository_id", "type", "'c' as primary_class", "repository_id * 1000000 as base", "explode(sequence(1, n)) as k"
    ).selectExpr("base + k as id", "repository_id", "type", "primary_class")
    wide = ct.repo_type_pivot(ct.class_cube(df, dim.repositories_table(spark))).collect()
    assert sorted((r.total, r.qda, r.qd, r.other, r.no_project) for r in wide) == sorted(PUBLISHED)
    assert sum(r.total for r in wide) == 89658
