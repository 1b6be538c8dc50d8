"""Vectors learned from texts: counts and mutual information by hand, eigenvectors by numpy, neighbours."""

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from archiveloom import dimensions as dim
from archiveloom.operators import cooccurrence as co
from archiveloom.operators import taxonomy as tax

TOPICS = ["sea ship sail harbour wave anchor", "court judge law trial jury verdict", "cell gene protein enzyme tissue virus"]


@pytest.fixture(scope="module")
def texts(spark):
    rng = np.random.default_rng(5)
    rows = [(" ".join(rng.choice(TOPICS[i % 3].split() + ["the", "of"], 40)),) for i in range(240)] + [(None,), ("",), ("sea",), ("sea", )]
    return spark.createDataFrame(rows, "text string").repartition(5)


def by_hand(texts, vocabulary):
    number, counts = {w: i for i, w in enumerate(vocabulary)}, collections.Counter()
    for r in texts.collect():
        tokens = (r["text"] or "").lower().split()
        for a in range(len(tokens)):
            for b in range(a + 1, min(a + 5, len(tokens))):
                if tokens[a] in number and tokens[b] in number:
                    counts[number[tokens[a]], number[tokens[b]]] += 1
                    counts[number[tokens[b]], number[tokens[a]]] += 1
    return counts


def test_pairs_and_vectors(texts):
    vocabulary = co.frequent_words(texts, "text", 15)
    every = collections.Counter(w for r in texts.collect() for w in (r["text"] or "").split())
    assert vocabulary == [w for w, _ in sorted(every.items(), key=lambda x: (-x[1], x[0]))[:15]]
    counts = by_hand(texts, vocabulary)
    pairs = co.near_pairs(texts, "text", vocabulary)
    assert {(r["i"], r["j"]): r["n"] for r in pairs.collect()} == counts
    rowsum, total = collections.Counter(), sum(counts.values())
    for (i, _), n in counts.items():
        rowsum[i] += n
    matrix = np.zeros((15, 15))
    for (i, j), n in counts.items():
        matrix[i, j] = max(0.0, math.log(n * total / (rowsum[i] * rowsum[j])))
    same, vectors = co.learned_vectors(texts, size=15, dimensions=4)
    values, axes = np.linalg.eigh(matrix)
    assert same == vocabulary
    top = np.argsort(-values)[:4]
    assert np.allclose(vectors @ vectors.T, (axes[:, top] * np.maximum(values[top], 0)) @ axes[:, top].T, atol=1e-6)
    _, again = co.learned_vectors(texts.repartition(3, F.col("text")), size=15, dimensions=4)
    assert np.allclose(vectors, again, atol=1e-9)
    assert co.learned_vectors(texts.where("false"))[1].shape == (0, co.DIMENSIONS)


def test_neighbours_and_classes(spark, texts):
    vocabulary, vectors = co.learned_vectors(texts, size=20, dimensions=3)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    for topic in TOPICS:
        group = [vocabulary.index(w) for w in topic.split()]
        for g in group:
            near = [i for i in np.argsort(-(unit @ unit[g])) if vocabulary[i] not in ("the", "of")][:6]
            assert sorted(near) == sorted(group)
    embedder = co.learned_embedder(vocabulary, vectors)
    got = spark.createDataFrame([("Sea, SHIP ship xyz",), (None,), ("",)], "t string").select(embedder(F.col("t")).alias("v")).collect()
    ship, sea = vocabulary.index("ship"), vocabulary.index("sea")
    assert np.allclose(got[0]["v"], 2 * vectors[ship] + vectors[sea]) and got[1]["v"] == got[2]["v"] == [0.0] * 3
    corpus = tax.division_corpus(dim.divisions_table(spark), dim.sections_table(spark))
    own_texts = corpus.select("text")
    fragments = corpus.where("idx < 5").select((F.col("idx") + 1).alias("project_id"), F.lit(0).alias("part"), F.lit(0).alias("seq"), "text")
    own = co.learned_embedder(*co.learned_vectors(own_texts, size=2000, dimensions=40))
    found = tax.classify_texts(fragments, "text", corpus, own).collect()
    labels = {r["idx"] + 1: r["label"] for r in corpus.select("idx", tax.division_label().alias("label")).collect()}
    assert all(r["primary_class"] == labels[r["project_id"]] for r in found) and len(found) == 5
