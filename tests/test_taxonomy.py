import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from archiveloom import dimensions as dim
from archiveloom.operators import keywords as kw
from archiveloom.operators import language as lg
from archiveloom.operators import taxonomy as tax
from archiveloom.operators import vectors as vec
from conftest import SF_SMALL, rows


def split_words(text):
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def bag(text, dimensions=vec.DIMENSIONS):
    out = np.zeros(dimensions)
    for w in split_words(text):
        out[int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % dimensions] += 1
    return out


TEXTS = ["fish fish Water", "", "mining of coal, coal", "Über-cool é1", None, "education"]


def corpus(spark):
    return tax.division_corpus(dim.divisions_table(spark), dim.sections_table(spark))


def brute_two(x, refs):
    def cos(a, b):
        n = np.linalg.norm(a) * np.linalg.norm(b)
        return float(a @ b / n) if n else 0.0

    scores = [cos(x, r) for r in refs]
    return sorted(range(len(refs)), key=lambda i: (-round(scores[i], 12), i))[:2]


def test_hashed_vectors(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    got = df.select("i", vec.hashed_embedder()(F.col("text")).alias("v")).collect()
    for r in got:
        assert np.array_equal(np.array(r.v), bag(TEXTS[r.i] or ""))


def test_summed_vectors_equal_the_vector_of_the_whole_text(spark):
    parts = [(1, "fish water"), (1, "coal fish"), (2, "education"), (1, "")]
    df = spark.createDataFrame(parts, "k long, text string")
    got = {r.k: np.array(r.vector) for r in vec.sum_vectors(df, "k").collect()}
    assert np.array_equal(got[1], bag("fish water coal fish")) and np.array_equal(got[2], bag("education"))


def test_nearest_two_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    refs = rng.normal(size=(23, 8))
    refs[9] = refs[4]  # an exact tie goes to the lower index
    queries = np.vstack([rng.normal(size=(40, 8)), refs[4], np.zeros(8)])
    ref_df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(refs)], "idx long, vector array<double>")
    data = [(i, q.tolist()) for i, q in enumerate(queries)] + [(99, None)]
    df = spark.createDataFrame(data, "i long, v array<double>")
    want = {i: brute_two(q, refs) for i, q in enumerate(queries)}
    monkeypatch.setattr(vec, "BLOCKS_PER_PLAN", 2)  # several blocks, staged now and then
    for block in (4096, 5):
        monkeypatch.setattr(vec, "REFERENCE_BLOCK", block)
        got = {r.i: [r["first"], r["second"]] for r in vec.nearest_two(df, "v", ref_df).collect()}
        assert got.pop(99) == [None, None]
        assert got == want
    assert want[40] == [4, 9] and want[41] == [0, 1]


def test_nearest_two_by_the_references_own_idx(spark, monkeypatch):
    refs = spark.createDataFrame([(0, [1.0, 0.0]), (7, [0.0, 1.0]), (5000, [1.0, 1.0]), (None, [9.0, 1.0])], "idx long, vector array<double>")
    df = spark.createDataFrame([(1, [0.1, 2.0]), (2, [2.0, 2.0])], "i long, v array<double>")
    for block in (4096, 2, 1):
        monkeypatch.setattr(vec, "REFERENCE_BLOCK", block)
        got = {r.i: [r["first"], r["second"]] for r in vec.nearest_two(df, "v", refs).collect()}
        assert got == {1: [7, 5000], 2: [5000, 0]}
    with pytest.raises(ValueError):
        vec.nearest_two(df, "v", refs.union(refs))
    none = vec.nearest_two(df, "v", refs.where("idx > 9000")).collect()
    assert [(r["first"], r["second_score"]) for r in none] == [(None, None)] * 2


def test_corpus_and_labels(spark):
    first = corpus(spark).where("idx = 0").first()
    assert first.label == "A01 - 01 - Crop and animal production, hunting and related service activities"
    assert first.text.startswith("Agriculture, forestry and fishing. Crop")
    assert corpus(spark).count() == 87


def test_taxonomy_from_json(spark, tmp_path):
    (tmp_path / "t.json").write_text(
        '{"sections": {"A": "One", "B": "Two"},\n "divisions": [{"section": "B", "code": "9", "title": "x"},'
        ' {"section": "A", "code": "1", "title": "y"}]}'
    )
    sections, divisions = dim.read_taxonomy(spark, str(tmp_path / "t.json"))
    got = rows(tax.division_corpus(divisions, sections).select("idx", "label", "text"))
    assert got == [(0, "B9 - 9 - x", "Two. x"), (1, "A1 - 1 - y", "One. y")]


def project_inputs(spark):
    projects = spark.createDataFrame(
        [(1, "QD_PROJECT", "coal mining", None), (2, "QDA_PROJECT", "", None), (3, "OTHER_PROJECT", None, "  ")],
        "id long, type string, title string, description string",
    )
    keywords = spark.createDataFrame([(5, 1, "lignite"), (4, 1, "Coal"), (6, 1, ""), (7, 2, None)], "id long, project_id long, keyword string")
    files = spark.createDataFrame(
        [(1, 1, "coal_and_lignite.pdf", None), (2, 1, "x1.pdf", None), (3, 2, "school_education.mp3", ""),
         (4, 2, "a.csv", None), (5, 3, "good_name.pdf", None), (6, 1, "Thumbs.db", "pdf")],
        "id long, project_id long, file_name string, file_type string",
    )
    return projects, keywords, files


def test_project_text_and_classes(spark, monkeypatch):
    projects, keywords, files = project_inputs(spark)
    fragments = tax.project_fragments(projects, keywords, files)
    texts = {r.project_id: r.text for r in tax.project_text(fragments).collect()}
    assert texts[1] == "coal mining Coal lignite coal_and_lignite.pdf x1.pdf Thumbs.db"
    assert texts[2] == "school_education.mp3 a.csv"
    # the ranges that are put in order first do not show
    for ids in (1, 2, 3):
        monkeypatch.setattr(tax, "RANGE_IDS", ids)
        assert {r.project_id: r.text for r in tax.project_text(fragments).collect()} == texts
    assert tax.project_text(fragments).columns == ["project_id", "text"]


def test_a_project_of_many_fragments_is_one_text(spark):
    n = 70_000
    files = spark.range(n).select(F.lit(1).cast("long").alias("project_id"), F.lit(4).alias("kind"), F.col("id").alias("seq"), F.concat(F.lit("f"), "id").alias("text"))
    (got,) = tax.project_text(files.repartition(7)).collect()
    assert got.text == " ".join(f"f{i}" for i in range(n))


def test_classify_projects_and_files(spark):
    projects, keywords, files = project_inputs(spark)
    table = corpus(spark)
    refs = [(r.label, bag(r.text)) for r in table.orderBy("idx").collect()]
    nearest = lambda text: tuple(refs[i][0] for i in brute_two(bag(text), [v for _, v in refs]))

    done, classified = tax.classify(projects, keywords, files, table)
    got = {r.id: (r.primary_class, r.secondary_class) for r in done.collect()}
    assert got[1] == nearest("coal mining Coal lignite coal_and_lignite.pdf x1.pdf Thumbs.db")
    assert got[2] == nearest("school_education.mp3 a.csv")

    by_file = {r.id: (r.primary_class, r.secondary_class) for r in classified.collect()}
    assert by_file[1] == nearest("coal and lignite")
    assert by_file[2] == got[1]  # too few words in the name: the project's classes
    assert by_file[3] == nearest("school education")
    assert by_file[4] == by_file[5] == by_file[6] == (None, None)
    with pytest.raises(ValueError):
        tax.classify(projects, keywords, files, table, scope="some")


def test_empty_text_has_no_class(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "coal")], "i int, text string")
    got = {r.i: r.primary_class for r in tax.classify_texts(df, "text", corpus(spark)).collect()}
    assert got[1] is None and got[2] is None and got[3] is not None


def test_tags_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    counts = {d: {} for d in texts}
    for d, t in texts.items():
        for w in split_words(t):
            if len(w) >= 2 and w not in kw.STOP_WORDS:
                counts[d][w] = counts[d].get(w, 0) + 1
    df = {}
    for c in counts.values():
        for w in c:
            df[w] = df.get(w, 0) + 1
    want = {}
    for d, c in counts.items():
        scored = sorted(((-round(n * math.log(len(texts) / df[w]), 6), w) for w, n in c.items()))[:5]
        want[d] = [w for _, w in scored]
    got = {r.doc_id: r.tags for r in kw.tag_arrays(kw.top_tags(docs, "doc_id"), "doc_id").collect()}
    assert got == {d: t for d, t in want.items() if t}


def test_language(spark):
    texts = ["the cat and the dog", "der Hund und die Katze", "le chat et les chiens", "el perro y los gatos", "xyz", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(lg.detect_language(F.col("t"))).collect()]
    assert got == ["en", "de", "fr", "es", None, None, None]
    one = spark.createDataFrame([("fr", "the and"), ("", "the and"), (None, "der und")], "d string, t string")
    assert [r[0] for r in one.select(lg.language_or_detected(F.col("d"), F.col("t"))).collect()] == ["fr", "en", "de"]


def test_language_accuracy_on_the_documents(spark):
    table = lg.detection_accuracy(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), "text", "lang").collect()
    right = sum(r.n for r in table if r.truth == r.detected)
    assert right / sum(r.n for r in table) > 0.9


def test_nearest_tags(spark):
    texts = ["coal coal mine the the the", "a an", "zeta alpha", ""]
    fragments = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    tags = lambda embedder, vectors: {r.k: r.tags for r in kw.tag_arrays(kw.nearest_tags(fragments, "k", vectors, embedder), "k").collect()}
    want = {0: ["coal", "mine"], 2: ["alpha", "zeta"]}
    assert tags(None, vec.sum_vectors(fragments, "k")) == want
    # the general way gives the same with the same embedder
    embedder = vec.hashed_embedder()
    assert tags(embedder, fragments.select("k", embedder(F.col("text")).alias("vector"))) == want


def test_extensions_from_json(spark, tmp_path):
    (tmp_path / "e.json").write_text('{\n "A": [".QDP", " .x"],\n "B": [],\n "C": [".x"]}')
    got = rows(dim.read_extensions(spark, str(tmp_path / "e.json")))
    assert got == [("A", "qdp"), ("A", "x"), ("C", "x")]


def test_projects_get_tags(spark):
    projects, keywords, files = project_inputs(spark)
    done, _ = tax.classify(projects, keywords, files, corpus(spark), scope="projects")
    tags = {r.id: r.tags for r in done.collect()}
    assert "coal" in tags[1] and len(tags[1]) == 5


def test_another_embedder(spark, monkeypatch):
    """Any text-to-vector expression can stand in for the bag of words, linear or not."""
    alphabet = "acdeilmnorst"
    # the square of the share of each letter: the vector of a whole is no sum over its parts
    letters = lambda text: F.array(*[F.pow(F.regexp_count(F.lower(text), F.lit(c)) / F.length(text), F.lit(2)) for c in alphabet])
    count = lambda text: np.array([(text.lower().count(c) / len(text)) ** 2 for c in alphabet])
    projects, keywords, files = project_inputs(spark)
    table = corpus(spark)
    refs = [(r.label, count(r.text)) for r in table.orderBy("idx").collect()]
    whole = "coal mining Coal lignite coal_and_lignite.pdf x1.pdf Thumbs.db"
    want = [refs[i][0] for i in brute_two(count(whole), [v for _, v in refs])]
    cosine = lambda w: float(count(w) @ count(whole) / np.linalg.norm(count(w)) / np.linalg.norm(count(whole)))
    scores = {w: round(cosine(w), 9) if count(w).any() else 0.0 for w in set(split_words(whole)) - {"and"}}
    tags = sorted(scores, key=lambda w: (-scores[w], w))[:5]
    for ids in (tax.RANGE_IDS, 2):
        monkeypatch.setattr(tax, "RANGE_IDS", ids)
        done, _ = tax.classify(projects, keywords, files, table, "projects", letters)
        got = next(r for r in done.collect() if r.id == 1)
        assert [got.primary_class, got.secondary_class] == want
        assert got.tags == tags  # by the same embedder
