"""Resampling, SentencePiece and whitening: brute force, the library itself, and defined cases."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from brute import WORDS, lower
from pyspark.sql import functions as F

import public_tokenizers
from archiveloom.llm import importance, pieces, queries, whitening

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"x{i % 977}" for i in range(60_000))
MODEL = public_tokenizers.path(queries.PIECES)
# what the operators add or use inside
CLASHES = ("id", "text2", "n", "bucket", "side", "n_words", "n_features", "weight", "score", "rank", "place", "eligible", "ids", "n_tokens", "decoded", "w", "k", "x", "part", "_drawn_row")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, "The Cat and the cat " * 6), (2, "wörld ÄB cd-ef 12 " * 9), (3, None), (4, ""), (5, " \n\t "), (6, LONG), (7, "z" * 5000 + " a b"),
        (8, "The Cat and the cat " * 6), (8, "The Cat and the cat " * 6), (None, "one two three four " * 7), (None, "one two three four " * 7), (None, None),
        (9, "a▁b  c <s>\x00漢😀"), (10, "few words"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return df.withColumns({c: F.lit("7") for c in CLASHES})


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# 11 -----------------------------------------------------------------------------------------


def scored(docs, target, n=1, n_buckets=10_000, percent=10, min_words=20):
    """[(id, n_features, weight, score)] sorted, and the ids drawn in order with their scores."""
    runs = lambda t, k: [" ".join(w[j : j + k]) for w in [WORDS.findall(lower(t))] for j in range(len(w) - k + 1)]
    buckets = lambda t: [zlib.crc32(f.encode()) % n_buckets for k in range(1, n + 1) for f in runs(t, k)]
    s, t = collections.Counter(), collections.Counter()
    for side, texts in ((s, [d[1] for d in docs]), (t, target)):
        for text in texts:
            side.update(buckets(text))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + n_buckets) / ((s[b] + 1) * (t_all + n_buckets))))
    out, eligible = [], []
    for id_, text in docs:
        own = buckets(text)
        weight = sum(map(gain, own)) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{'' if id_ is None else id_}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append((id_, len(own), weight, score))
        if len(runs(text, 1)) >= min_words:
            eligible.append((-score, id_ is None, id_ or 0))
    drawn = sorted(eligible)[: percent * len(eligible) // 100]
    return sorted(out, key=repr), [(None if none else id_, -score) for score, none, id_ in drawn]


def check_ranked(df, want, drawn):
    found = df.collect()
    assert sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in found), key=repr) == want
    got = sorted((r["rank"], r["doc_id"], r["score"]) for r in found if r["rank"] is not None)
    assert [g[1:] for g in got] == drawn
    assert [g[0] for g in got] == list(range(1, len(got) + 1))


def test_resampling_query(spark):
    texts = [r["text"] for r in queries.table(spark, SF, "benchmark").collect()]
    want, drawn = scored(pairs(queries.table(spark, SF, "documents")), texts)
    assert len(drawn) > 5
    check_ranked(queries.op11_importance_resampling(spark, SF), want, drawn)


@pytest.mark.parametrize("n,n_buckets", [(1, 10_000), (3, 61)])
def test_resampling_cases(spark, docs, none, n, n_buckets):
    target = spark.createDataFrame([("the Cat sat",), (None,), ("",)], "text string")
    gain = importance.learned(docs, target, n, n_buckets)
    want, drawn = scored(pairs(docs), ["the Cat sat", None, ""], n, n_buckets, 60)
    check_ranked(importance.ranked(docs, gain, 60, max_words=n), want, drawn)
    kept = importance.drawn_documents(docs, gain, 60, max_words=n)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {d[0] for d in drawn}
    assert importance.ranked(none, gain, max_words=n).count() == 0
    assert importance.drawn_documents(none, gain, max_words=n).count() == 0
    flat = importance.learned(none, target.where("false"), n, n_buckets)
    assert flat == [0] * n_buckets


def test_weights_replace_columns(docs):
    rows = importance.weighed(docs, [0] * 100)
    assert [c for c in rows.columns if c in ("n_words", "weight")] == ["n_words", "weight"]
    assert rows.where("id = '7' and weight = 0").count() == docs.count()


def test_crc_of_every_length():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 40_000, dtype=np.uint8)
    lengths = np.append(rng.integers(0, 30, 800), [importance.LONG, importance.LONG + 1, 9000])
    starts = rng.integers(0, 30_000, len(lengths))
    want = [zlib.crc32(data[a : a + n].tobytes()) for a, n in zip(starts, lengths)]
    assert importance.crc32(data, starts, lengths).tolist() == want


# 12 -----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.vocabulary(MODEL)


def by_library(model, text):
    ids = model.encode(text or "", add_bos=True, add_eos=True)
    return ids, model.decode(ids)


def test_pieces_query(spark, model):
    want = []
    for id_, text in pairs(queries.table(spark, SF, "documents")):
        ids, back = by_library(model, text)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want.append((id_, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(back.encode())))
    assert sorted(tuple(r) for r in queries.op12_merge_rounds(spark, SF).collect()) == sorted(want)


@pytest.mark.parametrize("packed", [False, True])
def test_pieces_cases(docs, none, model, packed):
    rows = pieces.decoded(pieces.encoded(docs, MODEL, packed=packed), MODEL)
    assert sorted(rows.columns) == sorted(docs.columns)  # its own columns replace those of the same name
    found = rows.collect()
    assert len(found) == docs.count()
    for r in found:
        ids, back = by_library(model, r["text"])
        got = np.frombuffer(r["ids"], "<u4").tolist() if packed else r["ids"]
        assert (got, r["n_tokens"], r["decoded"], r["weight"]) == (ids, len(ids), back, "7")
    assert pieces.decoded(pieces.encoded(none, MODEL, packed=packed), MODEL).count() == 0


def test_pieces_of_random_texts(model, vocabulary):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("ab ▁ \t\n.é漢<>/s0xE2日本😀\0�thein") for _ in range(rnd.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(rnd.choice("thequickbrownfox") for _ in range(4000)) for _ in range(5)]  # one word, many rounds
    texts += [" " * 70, "a" * 3000, "▁▁a", "=" * 333, None]
    ids, first = pieces.encode(vocabulary, pa.array(texts), True, True)
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == [by_library(model, t)[0] for t in texts]


def test_decoding_any_ids(model, vocabulary, spark):
    rnd = random.Random(6)
    lists = [[rnd.choice([rnd.randint(0, 31_999), rnd.randint(3, 258), rnd.randint(0, 3)]) for _ in range(rnd.randint(0, 30))] for _ in range(3000)]
    first = np.append(0, np.cumsum([len(x) for x in lists]))
    flat = np.array([i for x in lists for i in x])
    assert pieces.decode(vocabulary, flat, first).to_pylist() == [model.decode(x) for x in lists]
    rows = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r["decoded"] for r in pieces.decoded(rows, MODEL).collect()] == ["", ""]
    with pytest.raises(ValueError, match="outside"):
        pieces.decode(vocabulary, np.array([32_000]), np.array([0, 1]))


def test_pieces_that_go_alone_matter(model, vocabulary):
    """Merging every occurrence of them at once would change the result."""
    import dataclasses

    careless = dataclasses.replace(vocabulary, alone=np.zeros_like(vocabulary.alone))
    texts = [p.replace("▁", " ") * 3 for p in (model.id_to_piece(i) for i in range(259, 28_000))]
    ids, first = pieces.encode(vocabulary, pa.array(texts), False, False)
    want = model.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == want
    other, at = pieces.encode(careless, pa.array(texts), False, False)
    assert [other[a:b].tolist() for a, b in zip(at, at[1:])] != want


# 13 -----------------------------------------------------------------------------------------


def by_numpy(vectors, m=8):
    """Whole numbers, projections, explained shares and deviations."""
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    c = x - sums / n
    values, directions = np.linalg.eigh(c.T @ c / n)
    values, directions = values[::-1], directions[:, ::-1]
    return c @ directions[:, :m] / np.sqrt(values[:m]), values[:m] / values.sum(), [sum(int(n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]


def check_whitened(df, ids, vectors, m=8):
    found = collections.defaultdict(list)
    for r in df.collect():
        assert r["n"] == len(vectors) and r["identity_error"] < 1e-9
        found[r["vec_id"]].append((r["component"], r["whitened"], r["explained"], r["deviation"]))
    w, share, deviation = by_numpy(vectors, m)
    assert set(found) == set(ids)
    sign = np.ones(m)
    for c in range(m):
        own = [[f for f in found[i] if f[0] == c + 1][0] for i in ids]
        sign[c] = 1 if np.dot([o[1] for o in own], w[:, c]) > 0 else -1
        np.testing.assert_allclose([o[1] for o in own], sign[c] * w[:, c], atol=1e-8)
        np.testing.assert_allclose([o[2] for o in own], share[c], rtol=1e-9)
        assert [o[3] for o in own] == deviation


def test_whitening_query(spark):
    rows = queries.table(spark, SF, "embeddings").collect()
    check_whitened(queries.op13_block_whitening(spark, SF), [r["vec_id"] for r in rows], [r["embedding"] for r in rows])


@pytest.mark.parametrize("block_bytes", [1, 200, whitening.BLOCK_BYTES])
def test_whitening_in_blocks(spark, block_bytes):
    """One row a block, several column groups, and one block a task give the same."""
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(150, 5)) * [3, 1, 0.5, 0.2, 0.1] + [0, 5, 0, 0, -2]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(4)
    check_whitened(whitening.whitened(rows, 3, block_bytes=block_bytes), range(150), vectors, 3)


def test_whitening_cases(spark):
    rng = np.random.default_rng(5)
    good = rng.normal(size=(20, 3)).tolist()
    bad = [None, [], [1.0, None, 2.0], [1.0, float("nan"), 0.0], [float("inf"), 0.0, 0.0], [1e300, 0.0, 0.0], [1.0, 2.0], [1.0] * 4]
    rows = [(i, v, 1) for i, v in enumerate(good + good[:1])] + [(100 + i, v, None) for i, v in enumerate(bad)]
    extra = {c: F.lit(7) for c in ("id", "n", "component", "ids", "k", "w", "vector", "deviation", "part")}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns(extra)
    check_whitened(whitening.whitened(df), range(21), good + good[:1], 3)  # three dimensions, three components
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for empty in (df.where("false"), df.where("vec_id >= 100 and size(embedding) = 3"), df.where("vec_id = 3")):
        assert whitening.whitened(empty).columns == columns and whitening.whitened(empty).count() == 0
    same = df.where("vec_id < 5").withColumn("vec_id", F.lit(None).cast("long"))  # ids that do not tell rows apart
    assert whitening.whitened(same).where("vec_id is null").count() == 5 * 3
    flat = df.where("vec_id < 20").withColumn("embedding", F.transform("embedding", lambda v, i: F.when(i == 2, F.lit(1.0)).otherwise(v)))
    assert whitening.whitened(flat).agg(F.max("component")).first()[0] == 2  # a direction without variance
    far = df.where("vec_id < 20").withColumn("embedding", F.transform("embedding", lambda v: v * 1e9))
    assert whitening.whitened(far).where("deviation is not null").count() == 0  # beyond 64 bits
