import logging
import random

import pytest
from pyspark.sql import functions as F

from archiveloom.operators import merge
from archiveloom.operators.components import link_components
from fixpoint import Record, closure, record, violations

SCHEMA = "ord long, project_url string, doi string, title string, repository_id long"


def random_sets(n_sets, seed, dense):
    """Independent random record sets, kept apart by a prefix in every key."""
    rnd = random.Random(seed)
    records = []
    for s in range(n_sets):
        size = rnd.randint(2, 14)
        pool = rnd.randint(2, 3 if dense else 6)

        def text(kind):
            """A raw text and its key: missing, blank, or a value in some spelling."""
            pick = rnd.random()
            if pick < 0.25:
                return None, None
            if pick < 0.33:
                return rnd.choice(["", " ", " "] + (["/"] if kind == "u" else [])), None
            key = f"{kind}{s}x{rnd.randrange(pool)}"
            return rnd.choice([key, key.upper(), f" {key} "] + ([key + "/"] if kind == "u" else [])), key

        for j in range(size):
            repo = None if rnd.random() < 0.3 else s * 10 + rnd.randrange(2)
            (url, u), (doi, d), (title, t) = text("u"), text("d"), text("t")
            records.append(Record(s * 100 + j, url, doi, title, repo, u, d, t))
    return records


def plain(*rows):
    """Records whose texts are their keys."""
    return [record(o, u, d, t, r, (u, d, t)) for o, u, d, t, r in rows]


def chain(start, length, name, titles=False):
    """Each record shares one key with the one before and another with the one after."""
    title = lambda i: f"x{name}" if titles and i % 50 == 7 else None
    return plain(*[(start + i, f"c{name}u{i // 2}", f"c{name}d{(i + 1) // 2}", title(i), i % 3 or None) for i in range(length)])


def merged(spark, records):
    shuffled = random.Random(1).sample([tuple(r)[:5] for r in records], len(records))
    found = merge.assign_clusters(spark.createDataFrame(shuffled, SCHEMA)).collect()
    labels = {r.ord: r.label for r in found}
    assert sorted(r.ord for r in found) == sorted(r.ord for r in records)
    assert all(label <= order and labels[label] == label for order, label in labels.items())
    return labels


@pytest.mark.parametrize("seed,dense", [(7, True), (8, False), (11, True)])
def test_every_label_follows_from_the_others(spark, seed, dense):
    records = random_sets(4000, seed, dense)
    assert violations(records, merged(spark, records)) == []


def test_one_title_held_by_most_records(spark):
    records = plain(*[(i, f"http://x/{i % 7000}", None, "interview", 3) for i in range(20000)])
    records += [record(20000 + i, f"http://x/{i}/", "10.1/a", "Other", None, (f"http://x/{i}", "10.1/a", "other")) for i in range(3000)]
    found = merged(spark, records)
    assert violations(records, found) == []
    assert set(found.values()) == {0}


# records (place, URL, DOI, title, repository) and the label each must get
CASES = [
    # a URL hit beats a DOI hit
    (1, "u/1", "d1", None, None, 1), (2, "u/2", "d2", None, None, 2), (3, "U/1//", "d2", None, None, 1),
    # a record matched by DOI does not make its own URL a key of the cluster
    (10, "u/10", "d10", None, None, 10), (11, "u/11", "d10", None, None, 10), (12, "u/11", None, None, None, 12),
    # a bridge between two clusters joins the first and merges nothing
    (20, "u/20", None, None, None, 20), (21, None, "d21", None, None, 21), (22, "u/20", "d21", None, None, 20),
    (23, None, "d21", None, None, 21),
    # '' is set: the later URL is never taken over
    (30, "", "d30", None, None, 30), (31, "u/31", "d30", None, None, 30), (32, "u/31", None, None, None, 32),
    # title of one member, repository of another
    (40, None, "d40", "T", None, 40), (41, None, "d40", "other", 9, 40), (42, None, None, "t", 9, 40),
    # a title without a repository matches nothing; a blank DOI neither
    (50, None, " ", "Same", None, 50), (51, None, " ", "same", None, 51), (52, None, None, "SAME ", 4, 52), (53, None, None, "same", 4, 52),
    # a chain: every second record opens a cluster
    (60, "u60", "d60", None, None, 60), (61, "u61", "d60", None, None, 60), (62, "u61", "d62", None, None, 62),
    (63, "u63", "d62", None, None, 62), (64, "u63", "d64", None, None, 64),
]


def test_written_out_cases(spark):
    records = [record(*case[:5]) for case in CASES]
    assert merged(spark, records) == {case[0]: case[5] for case in CASES}


def rounds_of(caplog):
    """Records carried by each round, and the number of doublings."""
    carried = [r.args[1] for r in caplog.records if "round" in r.msg]
    return carried, sum("doubling" in r.msg for r in caplog.records)


def test_long_chains_and_settled_components(spark, caplog):
    """Only components that still move go on; the rest of the records settle early."""
    records = random_sets(300, 21, True) + chain(10**6, 34, "a", True) + chain(2 * 10**6, 12, "b")
    with caplog.at_level(logging.INFO, logger=merge.__name__):
        found = merged(spark, records)
    assert violations(records, found) == []
    carried, doublings = rounds_of(caplog)
    assert len(carried) + doublings <= 20 and carried == sorted(carried, reverse=True)
    assert carried[-1] < 0.1 * carried[0]


@pytest.mark.parametrize("titles", [False, True])
def test_rounds_grow_with_the_logarithm_of_a_chain(spark, caplog, titles):
    records = chain(0, 5000, "a", titles)
    with caplog.at_level(logging.INFO, logger=merge.__name__):
        found = merged(spark, records)
    assert violations(records, found) == []
    carried, doublings = rounds_of(caplog)
    assert len(carried) + doublings <= 20


def test_chain_of_groups(spark, caplog):
    """Every link of the chain is a group of copies with gaps, so decisions hang on several records."""
    rnd = random.Random(4)
    records = []
    for i in range(300):
        for j in range(rnd.randint(1, 4)):
            url = f"u{i // 2}" if rnd.random() < 0.8 else None
            records.append((i * 10 + j, url, f"d{(i + 1) // 2}", f"t{i // 3}" if rnd.random() < 0.3 else None, rnd.choice([None, 1, 2])))
    records = plain(*records)
    with caplog.at_level(logging.INFO, logger=merge.__name__):
        found = merged(spark, records)
    assert violations(records, found) == []
    carried, doublings = rounds_of(caplog)
    assert len(carried) + doublings <= 60


def test_a_prediction_keeps_what_is_right(spark):
    """Predicting from the final assignment gives it back."""
    records = random_sets(500, 31, True) + chain(10**6, 40, "a", True)
    df = spark.createDataFrame([tuple(r)[:5] for r in records], SCHEMA)
    staging = merge.StagingArea(spark, "test")
    state, _ = merge.shared_keys(staging, merge.stage_keys(df, staging))
    state = merge._linked(state, staging).join(merge.assign_clusters(df), "ord")
    again, _ = merge._predicted(state, staging, 1)
    pairs = again.select("ord", F.col("label").alias("again")).join(state.select("ord", "label"), "ord")
    assert pairs.count() == state.count() and pairs.where("again <> label").count() == 0


def test_components_equal_closure(spark):
    records = random_sets(1500, 5, False) + plain(*[(10**6 + i, f"c{i // 2}", f"e{(i + 1) // 2}", None, None) for i in range(60)])
    df = spark.createDataFrame([tuple(r)[:5] for r in records], SCHEMA)
    assert {r.ord: r.component for r in link_components(df).collect()} == closure(records)


def test_coalesce_keeps_empty_strings_and_fills_nulls(spark):
    schema = "ord long, label long, " + ", ".join(
        f"{c} {t}" for c, t in merge.PROJECT_SOURCE_COLUMNS.items()
    )
    base = dict.fromkeys(merge.PROJECT_SOURCE_COLUMNS)
    data = [
        {"ord": 1, "label": 1, **base, "title": "", "doi": None},
        {"ord": 2, "label": 1, **base, "title": "later", "doi": "d", "repository_id": 4},
        {"ord": 3, "label": 3, **base, "title": "own"},
    ]
    df = spark.createDataFrame(data, schema)
    out = merge.coalesce_clusters(df.drop("label"), df.select("ord", "label"))
    got = {r.label: (r.title, r.doi, r.repository_id, r.members) for r in out.collect()}
    assert got == {1: ("", "d", 4, 2), 3: ("own", None, None, 1)}


def test_children_are_distinct_by_normalised_text(spark):
    files = spark.createDataFrame(
        [(1, 1, "A b.pdf", None, None), (1, 2, "a  B.PDF", "pdf", None), (1, 3, " ", "x", "y"),
         (1, 4, None, "x", "y"), (2, 5, "a b.pdf", "", "S")],
        "label long, ord long, file_name string, file_type string, status string",
    )
    got = sorted(tuple(r) for r in merge.dedupe_files(files).select("label", "file_name", "file_type", "ord").collect())
    assert got == [(1, "A b.pdf", "pdf", 1), (2, "a b.pdf", "", 5)]
    people = spark.createDataFrame(
        [(1, 1, "Ann", None), (1, 2, "ANN ", None), (1, 3, "Ann", "Owner"), (1, 4, None, " "), (1, 5, None, "x")],
        "label long, ord long, name string, role string",
    )
    got = sorted((r.ord, r.name, r.role) for r in merge.dedupe_person_role(people).collect())
    assert got == [(1, "Ann", None), (3, "Ann", "Owner"), (5, None, "x")]


def test_surrogate_ids_follow_opening_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 3).alias("ord"))
    assignment = df.withColumn("label", F.col("ord") - F.col("ord") % 6)
    staging = merge.StagingArea(spark, "test")
    got = {r.label: r.id for r in merge.surrogate_ids(assignment, staging).collect()}
    assert got == {label: i for i, label in enumerate(range(0, 15000, 6), 1)}
