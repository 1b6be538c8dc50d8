"""Registered queries against SQL; the pipeline against brute force, stage by stage."""

import collections
import os
import sys

import pytest
from brute import contamination, linked, poisson
from pyspark.sql import functions as F

import corpus_pipeline
from archiveloom.llm import jaccard, mixing, queries

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
import compare

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    numbers = [int(n[2:].split("_")[0]) for n in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert set(queries.SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    ok, message = compare.compare(spark, compare.connect(SF), SF, name, queries.QUERIES[name], queries.SQL[name])
    assert ok, message


@pytest.mark.parametrize("name", ["op9_schema_chat", "op10_line_frequency"])
def test_native(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_pairwise_join(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython"))


def test_pipeline(spark, tmp_path):
    docs = queries.table(spark, SF, "documents")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        out = stage(spark, before, SF)
        path = str(tmp_path / name.replace(" ", "_"))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = ([tuple(r) for r in before.select("doc_id", "text", "source").collect()], docs.collect())
        assert docs.columns[: len(columns)] == columns
    ids = lambda rows: sorted(r[0] for r in rows)

    before, after = seen["language ID"]
    assert set(ids(after)) <= set(ids(before)) and len(after) > 0.95 * len(before)

    before, after = seen["n-gram Jaccard join"]
    assert ids(after) == sorted({c for _, _, c in linked([b[:2] for b in before])})

    before, after = seen["benchmark decontamination"]
    items = [(r["item_id"], r["text"]) for r in queries.table(spark, SF, "benchmark").collect()]
    assert ids(after) == sorted(r[0] for r in contamination([b[:2] for b in before], items) if not r[-1])

    before, after = seen["mixing sources to target weights"]
    size = collections.Counter()
    for _, text, source in before:
        size[source] += len((text or "").encode()) + 1
    weight = {s: n**queries.MIX_EXPONENT for s, n in size.items()}
    rate = {s: weight[s] / sum(weight.values()) * sum(size.values()) / size[s] for s in size}
    want = {i: poisson(queries.MIX_SEED, i, t, rate[s]) for i, t, s in before}
    assert collections.Counter(ids(after)) == collections.Counter({i: n for i, n in want.items() if n})

    before, after = seen["sharding"]
    assert ids(after) == ids(before)
    counts = collections.Counter(r["shard"] for r in after)
    assert max(counts.values()) - min(counts.values() if len(counts) == queries.N_SHARDS else [0]) <= 1
    assert len({(r["shard"], r["slot"]) for r in after}) == len(after)


def test_near_duplicates_of_the_pipeline(spark):
    """Five words and 80 percent: copies that four words and 85 percent let pass, and those given."""
    words = [f"w{i}" for i in range(600)]
    rows = [(1, " ".join(words[:500])), (2, " ".join(words)), (3, " ".join(words[:300]))]  # five-word similarity 0.83, 0.597
    near = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' as lang", "'s' as source", "1L as n_chars")
    given = queries.table(spark, "/root/testdata/sf0.01", "documents").withColumn("doc_id", F.col("doc_id") + 10)
    docs = given.unionByName(near)
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = {c for _, _, c in linked(pairs, 5, 80)}
    assert want != {c for _, _, c in linked(pairs)} and {1, 3} <= want and 2 not in want
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()) == sorted(want)


def test_rows_without_an_id_of_their_own(spark):
    """Only rows whose texts link go, whatever ids they share."""
    text = lambda c, n=40: " ".join(f"{c}{i}" for i in range(n))
    last = jaccard.LAST_ID
    rows = [
        (None, text("a")), (None, text("b")), (None, text("b")), (None, None), (None, " \n"), (None, ""),  # NULL ids
        (1, text("c")), (1, text("d")), (1, text("c")), (2, text("c") + " x"),  # one id, two texts
        (3, text("e") + " x"), (4, text("e")), (4, text("f")), (None, text("e")),  # a near copy's id has another text
        (5, ""), (5, ""), (int(last), text("a") + " x"), (None, text("g")), (6, text("g")),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'en' as lang", "'s' as source", "1L as n_chars")
    out = corpus_pipeline.drop_near_duplicates(spark, docs.repartition(4), SF)
    assert out.columns == docs.columns
    found = collections.Counter((r["doc_id"], r["text"]) for r in out.collect())
    first = found.keys() & {(None, text("a")), (int(last), text("a") + " x")}
    assert len(first) == 1  # the largest id and a missing one rank alike
    want = [
        *first, (None, text("b")), (None, None), (None, " \n"), (None, ""), (1, text("c")), (1, text("d")),
        (3, text("e") + " x"), (4, text("f")), (5, ""), (5, ""), (6, text("g")),
    ]
    assert found == collections.Counter(want)


def test_pipeline_of_nothing(spark):
    docs = queries.table(spark, SF, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_mixing_reaches_the_weights(spark):
    docs = queries.table(spark, SF, "documents")
    sizes = mixing.source_sizes(docs)
    rate = {r["source"]: r["rate"] for r in mixing.rates(sizes, mixing.tempered(sizes, 0.0)).collect()}
    shares = [rate[r["source"]] * r["size"] for r in sizes.collect()]
    assert max(shares) == pytest.approx(min(shares))
