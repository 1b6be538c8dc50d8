"""Trigram profiles and the maintained cube, against plain Python."""

import collections
import math
import random

from pyspark.sql import functions as F

from archiveloom.operators import cube as cb
from archiveloom.operators import profiles as pf
from conftest import rows

TEXTS = {
    "en": "the cat and the other thing that they thought of", "de": "der Hund und die anderen Dinge der Straße",
    "pl": "żółty kot nie jest wcale taki zły", "el": "η γάτα και το σπίτι της θάλασσας", "ru": "кошка сидит на старом окне",
}


def grams(text):
    line = f" {' '.join(''.join(c if c.isalpha() and ord(c) < 0x10000 else ' ' for c in (text or '').lower()).split())} "
    return [line[i : i + 3] for i in range(len(line) - 2)]


def by_python(labelled, texts, size):
    """(detected, score) of each text."""
    counts = {lang: collections.Counter() for lang, t in labelled if lang is not None}
    for lang, text in labelled:
        if lang is not None:
            counts[lang].update(grams(text))
    kinds = len({g for c in counts.values() for g in c})
    scaled = lambda x: math.floor(1e6 * math.log(x) + 0.5)
    out = []
    for text in texts:
        own = grams(text)
        found = []
        for lang, c in counts.items():
            top = dict(sorted(c.items(), key=lambda x: (-x[1], x[0]))[:size])
            if any(g in top for g in own):
                total = sum(scaled(top[g] + 1) for g in own if g in top) - len(own) * scaled(sum(c.values()) + kinds)
                found.append((-total, lang))
        best = min(found, default=None)
        out.append((best and best[1], best and -(best[0] // len(own))))
    return out


def test_profiles(spark):
    rnd = random.Random(3)
    labelled = [(lang, " ".join(rnd.sample(t.split(), 5))) for lang, t in TEXTS.items() for _ in range(6)] + [(None, "the the"), ("en", None)]
    profiles = pf.learn_profiles(spark.createDataFrame(labelled, "lang string, text string").repartition(3), size=40)
    assert {r["lang"]: r["n"] for r in profiles.groupBy("lang").agg(F.count("*").alias("n")).collect()}["pl"] <= 40
    texts = [*TEXTS.values(), *[" ".join(rnd.sample(t.split(), 3)) for t in TEXTS.values()], None, "", "12 34 !?", "😀😀 the 😀", "the " * 30_000, "xqxqxq"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("lang", F.lit("no")).withColumn("gram", F.lit("no"))
    got = {r["doc_id"]: (r["detected"], r["score"]) for r in pf.detect_by_profiles(docs, profiles).collect()}
    want = by_python(labelled, texts, 40)
    assert [got[i][0] for i in range(len(texts))] == [w[0] for w in want]
    assert [got[i][0] for i in range(5)] == list(TEXTS)  # more than the languages with lists of function words
    assert all(abs((got[i][1] or 0) - (w[1] or 0)) <= 1 for i, w in enumerate(want))  # div cuts towards zero
    assert [got[i][0] for i in (10, 11, 12, 15)] == [None] * 4
    table = pf.accuracy(pf.detect_by_profiles(docs.where("doc_id < 5"), profiles), docs.select("doc_id", F.element_at(F.array(*map(F.lit, TEXTS)), (F.col("doc_id") % 5 + 1).cast("int")).alias("lang")))
    assert rows(table) == sorted((lang, lang, 1) for lang in TEXTS)
    assert pf.detect_by_profiles(docs.where("false"), profiles).count() == 0
    assert pf.learn_profiles(docs.where("false")).count() == 0


def test_no_text_is_cut_once_per_trigram(spark):
    """A long text takes time in proportion to its length: nothing beside explode looks at the text."""
    profiles = pf.learn_profiles(spark.createDataFrame([("en", "the the")], "lang string, text string"))
    docs = spark.createDataFrame([(1, "the " * 200_000)], "doc_id long, text string")
    assert pf.detect_by_profiles(docs, profiles).collect()[0]["detected"] == "en"


def test_cube_follows_any_change(spark):
    rnd = random.Random(9)
    value = lambda: (rnd.choice([1, 2, None]), rnd.choice([None, "", "QDA_PROJECT", "odd"]), rnd.choice([None, "", "A", "B"]))
    now = {i: value() for i in range(300)}
    frame = lambda found: spark.createDataFrame([(i, *v) for i, v in found.items()], "id long, repository_id long, type string, primary_class string")
    counted = lambda found: rows(cb.cells(frame(found)))
    cube = cb.cells(frame(now))
    for turn in range(3):
        touched = rnd.sample(sorted(now), 60)
        before = {i: now[i] for i in touched}
        for i in touched:
            if rnd.random() < 0.5:
                del now[i]
            elif rnd.random() < 0.8:
                now[i] = value()
        if turn == 1:  # a cell is emptied
            for i in [i for i, v in now.items() if v[0] == 2]:
                before.setdefault(i, now[i])
                del now[i]
        for i in range(1000 * turn + 1000, 1000 * turn + 1020):
            now[i] = value()
        after = {i: v for i, v in now.items() if i in before or i >= 1000 * turn + 1000}
        cube = cb.maintained(cube, frame(before), frame(after), frame(now))
        assert rows(cube) == counted(now)
    same = cb.maintained(cube, frame({}), frame({}), frame({}))
    assert rows(same) == counted(now)
