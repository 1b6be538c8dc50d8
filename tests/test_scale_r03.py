"""Plans and bounds that keep shuffles, sorts and Python workers small."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from archiveloom.operators import cooccurrence as co
from archiveloom.operators import keywords as kw
from archiveloom.operators import merge as mg
from archiveloom.operators import profiles as pf
from archiveloom.operators import taxonomy as tax
from archiveloom.plans import bindings as b
from archiveloom.sources import landing as ld
from archiveloom.staging import StagingArea

DOCS = "doc_id long, lang string, text string, source string"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture()
def tables(spark, tmp_path):
    docs = [(i, "en", f"Title {i}\nbody of {i}", f"src{i % 5}") for i in range(20)] + [(None, "de", None, None), (3, "en", "again", "src1")]
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, f"http://x/{i}") for i in range(0, 20, 2)], "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    return str(tmp_path)


def test_harvested_moves_no_text_that_nobody_reads(spark, tables):
    found = b.harvested(spark, tables).select("doc_id", "title", "doi", "url")
    below_join = plan(found).split("Join", 1)[1]
    left = below_join.split("Relation", 1)[0]
    assert "split_part" in left or "title" in left  # cut out below the join ...
    assert "md5" in left
    assert not plan(found).split("Join", 1)[0].count("md5")  # ... and not above it
    rows = {(r.doc_id, r.title, r.url) for r in found.collect()}
    assert (2, "Title 2", "http://x/2") in rows and (3, "again", None) in rows and (None, None, None) in rows and len(rows) == 22


def test_values_carry_one_spelling_and_one_place(spark):
    rows = [(1, 5, "Coal "), (1, 3, " COAL"), (1, 9, "coal"), (1, 2, "ore"), (2, 7, "coal"), (1, 8, " \t "), (1, 6, None), (None, None, "Tin"), (None, None, "tin")]
    children = spark.createDataFrame(rows, "label long, ord long, keyword string")
    out = mg.dedupe_values(children, "keyword")
    assert out.columns == ["label", "keyword", "ord"]
    # without any place no spelling is the first, as ever
    assert {tuple(r) for r in out.collect()} == {(1, " COAL", 3), (1, "ore", 2), (2, "coal", 7), (None, None, None)}
    assert "min_by" not in plan(out) and plan(out).count("regexp_replace") == 1


def test_text_tables_are_read_in_small_splits(spark, tables):
    before = spark.conf.get(b.SPLIT_SETTING)
    try:
        spark.conf.unset(b.SPLIT_SETTING)
        b.texts(spark, tables)
        assert spark.conf.get(b.SPLIT_SETTING) == f"{b.SPLIT_BYTES}b"
        spark.conf.set(b.SPLIT_SETTING, "5m")  # what the session sets stays
        b.texts(spark, tables)
        assert spark.conf.get(b.SPLIT_SETTING) == "5m"
    finally:
        spark.conf.set(b.SPLIT_SETTING, before)


def test_fragments_are_gathered_as_strings_in_order(spark):
    rows = [(1, 3, s, f"w{s}") for s in (4096, 4095, 0, 64, 63, 8191, 10**15, -1, -4097)] + [(1, 3, 64, "v"), (1, 1, 0, "T"), (2, 3, None, "b"), (2, 3, None, "a")]
    fragments = spark.createDataFrame(rows, "project_id long, kind int, seq long, text string")
    texts = tax.project_text(fragments.repartition(3))
    assert {r.project_id: r.text for r in texts.collect()} == {1: f"T w-4097 w-1 w0 w63 v w64 w4095 w4096 w8191 w{10**15}", 2: "a b"}
    assert plan(texts).count("collect_list(struct") == 1  # of whole ranges only


def test_tags_split_texts_once(spark, tables):
    tags = kw.top_tags(spark.read.parquet(f"{tables}/documents.parquet"), "doc_id")
    tags.collect()
    assert "ReusedExchange" in tags._jdf.queryExecution().executedPlan().finalPhysicalPlan().toString()


def test_pairs_are_counted_in_pieces(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(" ".join(rng.choice(list("abcdefgh"), n)),) for n in rng.integers(0, 40, 60)] + [(None,), ("a b " * 50,)]
    texts = spark.createDataFrame(rows, "text string").repartition(2)
    vocabulary = list("abcdef")
    counted = lambda: {tuple(r) for r in co.near_pairs(texts, "text", vocabulary).collect()}
    whole = counted()
    for words in (1, 30):
        monkeypatch.setattr(co, "PIECE_WORDS", words)
        assert counted() == whole
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is not None


def test_trigrams_counted_as_numbers_are_those_of_the_expression(spark):
    rows = [("en", "The cat, the hat"), ("en", None), ("de", "Öl ß 𝔸bc 12"), ("de", ""), ("fr", "a"), ("fr", "İstanbul ẞ été 漢字"), ("en", "a b"), (None, "x y z")]
    texts = spark.createDataFrame(rows, "lang string, text string").where("lang is not null and text is not null").repartition(2)
    slow = texts.select("lang", F.explode(pf.trigrams(F.col("text"))).alias("gram")).groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("n"))
    assert {tuple(r) for r in pf.count_trigrams(texts).collect()} == {tuple(r) for r in slow.collect()}


def test_keywords_are_read_as_they_are_parsed(spark):
    body = '{"item":{"name":"n","description":"d","global_id":"g"},"version":{"metadataBlocks":{"citation":{"fields":[%s]}}}}'
    other = '{"typeName":"keyword","value":[{"keywordValue":{"value":"never read"}}]}'
    entries = '{"typeName":"keyword","value":[{"keywordValue":{"value":"a"}},{"other":1},null,{"keywordValue":{"value":"b"}}]}'
    landed = [(1, body % entries), (2, body % '{"typeName":"keyword","value":"text"}'), (3, body % ""), (4, body % (entries + "," + other))]
    out = ld.parse_dataverse(spark.createDataFrame(landed, "record_id long, json string"), "s")["keywords"]
    assert "transform(" not in plan(out) and out.columns == ["record_id", "seq", "keyword"]
    assert sorted(tuple(r) for r in out.where("keyword is not null").collect()) == [(1, 0, "a"), (1, 3, "b"), (4, 0, "a"), (4, 3, "b")]
    assert out.where("keyword is null").count() == 4


def test_staged_tables_are_compressed_well(spark):
    df, _ = StagingArea(spark, "codec").write(spark.range(10), "t")
    assert all(f.endswith(".zstd.parquet") for f in df.inputFiles())
