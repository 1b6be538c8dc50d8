"""The ten operators: brute force on real rows, and the cases their docstrings define."""

import collections
import time
import zlib

import numpy as np
import pytest
from brute import contamination, linked, poisson, without_repeats
from pyspark.sql import functions as F

from archiveloom.llm import chat, debruijn, decontam, jaccard, langid, lines, mixing, queries, ranking, sharding, tagpaths, urls

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
A = " ".join(f"w{i}" for i in range(40))
LONG = " ".join(f"x{i % 977}" for i in range(60_000))


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same(got, want):
    assert got == sorted((tuple(w) for w in want), key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    """NULLs in every column, empty, very long and repeated rows, clashing extra columns."""
    rows = [
        (1, A, "en", "s", 1), (2, A + " more words here", "en", "s", 1), (3, "W0 " + A[3:], None, None, None), (4, None, "en", "s", 0),
        (5, "", "en", None, 0), (6, " \n\t ", None, "t", 3), (7, LONG, "en", "t", 9), (8, LONG + " end", "en", "t", 9),
        (9, "two words", "en", "t", 9), (10, "two words", "en", "t", 9), (11, "intro " + A + " outro", "en", "u", 1),
    ]
    df = spark.createDataFrame(rows, DOCS)
    extra = {c: F.lit(7) for c in ("id", "key", "class", "n", "copy", "shard", "slot", "matches", "n_words", "score", "words", "host", "_n")}
    return df.withColumns(extra)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# 1 ------------------------------------------------------------------------------------------


def digest(found):
    items = found.withColumn("_items", decontam.items_hit())
    return items.select(
        "doc_id", "n_words", decontam.words_hit(), F.size("_items").cast("long"),
        F.sha2(F.array_join("_items", ",").cast("binary"), 256), F.size("matches") > 0,
    )


def test_contamination_query(spark):
    docs, items = queries.table(spark, SF, "documents"), queries.table(spark, SF, "benchmark")
    want = contamination(pairs(docs), [(r["item_id"], r["text"]) for r in items.collect()])
    assert any(w[-1] for w in want) and not all(w[-1] for w in want)
    same(tuples(queries.op1_suffix_arrays(spark, SF)), want)


ITEMS = [
    ("b", " ".join(f"W{i}" for i in range(5, 20))), ("a", " ".join(f"w{i}" for i in range(5, 20))), ("short", "two, Words"),
    ("none", None), (None, "x1 x2 x3 x4"), ("empty", "..."), ("twice", "x1 x2 x3 x4 x5 x6 x7 x8 x9 x10 x11"), ("twice", "w39"),
]


@pytest.mark.parametrize("test_bytes", [decontam.TEST_BYTES, 30])
def test_contamination_cases(spark, docs, none, monkeypatch, test_bytes):
    monkeypatch.setattr(decontam, "TEST_BYTES", test_bytes)  # 30: several passes
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    same(tuples(digest(decontam.matched(docs, items, keep=["doc_id"]))), contamination(pairs(docs), ITEMS))
    assert decontam.decontaminated(docs, items).columns == [c for c in docs.columns if c not in ("n_words", "matches")]
    assert decontam.matched(none, items).count() == 0
    assert decontam.matched(docs, items.where("false")).where(F.size("matches") > 0).count() == 0


def test_matches_are_longest_and_placed(spark):
    text = "start " + " ".join(f"w{i}" for i in range(3, 30)) + " stop"
    items = spark.createDataFrame([(1, A)], "item_id long, text string")
    found = decontam.matched(spark.createDataFrame([(1, text)], "doc_id long, text string"), items).first()["matches"]
    assert [tuple(m) for m in found] == [("1", 3, 1, 27)]


# 2 ------------------------------------------------------------------------------------------


def test_poisson_inversion(spark, docs, none):
    sizes = mixing.source_sizes(docs)
    weights = spark.createDataFrame([("s", 3.0), ("t", 1.0), (None, 2.0)], "source string, weight double")
    rate = mixing.rates(sizes, weights)
    rates = {r["source"]: r["rate"] for r in rate.collect()}
    size = {r["source"]: r["size"] for r in sizes.collect()}
    assert rates["s"] == pytest.approx(0.5 * sum(size.values()) / size["s"])
    assert max(rates.values()) > 256  # drawn as a sum of pieces
    got = collections.Counter(r["doc_id"] for r in mixing.replicate(docs, rate).collect())
    want = collections.Counter()
    for r in docs.collect():
        want[r["doc_id"]] += poisson(2, r["doc_id"], r["text"], rates.get(r["source"], 0.0))
    assert got == +want
    assert mixing.replicate(none, mixing.rates(mixing.source_sizes(none), weights)).count() == 0


def test_poisson_mean_and_copies(spark):
    many = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("s").alias("source"))
    rate = spark.createDataFrame([("s", 1.5)], "source string, rate double")
    out = mixing.replicate(many, rate)
    counts = collections.Counter(r["doc_id"] for r in out.select("doc_id").collect())
    assert sum(counts.values()) == pytest.approx(30_000, rel=0.02)
    spread = collections.Counter(counts.values())
    assert (20_000 - len(counts)) / 20_000 == pytest.approx(0.2231, abs=0.01) and spread[1] / 20_000 == pytest.approx(0.3347, abs=0.012)
    assert out.select("doc_id", "copy").distinct().count() == out.count()


def test_poisson_without_ids(spark):
    """Rows without an id draw by their texts and are spread; names of columns do not matter."""
    rows = spark.range(4000).select(
        F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"), F.lit("s").alias("source"),
        *[F.lit(i).alias(c) for i, c in enumerate(("rate", "pieces", "cdf", "_source", "_pieces", "_cdf", "_who", "_count"))],
    )
    rate = spark.createDataFrame([("s", 2.0)], "source string, rate double")
    out = mixing.replicate(rows, rate)
    assert out.columns == [*rows.columns, "copy", "shuffle_key"]
    found = out.collect()
    assert len(found) == pytest.approx(8000, rel=0.05) and len({r["shuffle_key"] for r in found}) == len(found)
    assert {tuple(r[3:11]) for r in found} == {tuple(range(8))}
    long = spark.createDataFrame([(1, "x" * 3_000_000, "s")], "doc_id long, text string, source string")
    assert {len(r["text"]) for r in mixing.replicate(long, spark.createDataFrame([("s", 40.0)], "source string, rate double")).collect()} == {3_000_000}


# 3 ------------------------------------------------------------------------------------------


def test_language_held_out_accuracy(spark):
    docs = queries.table(spark, SF, "documents").select("doc_id", "lang", "text")
    found = queries.op3_nearest_centroid(spark, SF).join(docs, "doc_id")
    held = found.where("held_out and lang is not null").collect()
    assert len(held) > 20 and sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in found.collect())
    assert found.where("rejected and length(text) > 200").count() == 0


def test_language_cases(spark, docs, none):
    model = langid.fit(queries.table(spark, SF, "documents"))
    rows = [(1, None), (2, ""), (3, "123 -- 456"), (4, "The and of the with this"), (5, "ж" * 400), (6, "the and of " * 40_000), (7, None)]
    asked = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x"))
    found = {r["doc_id"]: r for r in langid.identified(asked, model).collect()}
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 and found[i]["rejected"] for i in (1, 2, 3, 7))
    assert found[4]["lang_pred"] == "en" and found[6]["lang_pred"] == "en" and not found[6]["rejected"]
    assert found[5]["rejected"] and found[5]["lang_pred"] != "und"
    assert langid.identified(none, model).count() == 0
    assert langid.fit(none) is None
    assert {r["lang_pred"] for r in langid.identified(docs, None).collect()} == {"und"}


def test_language_sees_no_labels(spark):
    docs = queries.table(spark, SF, "documents")
    model = langid.fit(docs)
    plain = lambda df: tuples(langid.identified(df, model).select("doc_id", "lang_pred", "score"))
    assert plain(docs) == plain(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")))


# 4 ------------------------------------------------------------------------------------------

PAGES = [
    (1, "http://a.b.example.net/x?y#z"), (2, "https://EXAMPLE.com/de/1"), (3, "//no-scheme"), (4, None), (5, "ftp://x.org"),
    (6, "http://www.example.net/en/a"), (7, "http://q.org/fr/"), (8, "x://y.com?u=://z"), (9, "http://badexample.net/en/"), (1, "http://a.b.example.net/x?y#z"),
]


def test_url_parts_and_rules(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string").withColumn("host", F.lit("clash"))
    rules = spark.createDataFrame(queries.RULES, "rule string, verdict string")
    outcomes = spark.createDataFrame([(8, 1), (8, 1)], "page_id long, bad int")
    found = tuples(urls.judge(pages, outcomes, rules).select("page_id", "host", "path", "rule", "verdict"))
    want = [
        (1, "a.b.example.net", "/x", "net/", "block"), (1, "a.b.example.net", "/x", "net/", "block"), (2, "example.com", "/de/1", "example.com/de/", "block"),
        (3, "", "", None), (4, "", "", None), (5, "x.org", "", None), (6, "www.example.net", "/en/a", "example.net/en/", "allow"),
        (7, "q.org", "/fr/", "org/fr/", "allow"), (8, "y.com", "", None), (9, "badexample.net", "/en/", "net/", "block"),
    ]
    assert [f[: len(w)] for f, w in zip(found, sorted(want, key=repr))] == sorted(want, key=repr)
    assert urls.judge(pages.where("false"), outcomes, rules).count() == 0
    quiet = urls.judge(pages, outcomes.where("false"), rules.where("false"))
    assert {r["verdict"] for r in quiet.collect()} == {"allow"}


def test_reputation_shrinks_to_the_domain(spark):
    marks = [("a.spam.com", 1)] * 40 + [("b.spam.com", 1)] * 30 + [("www.good.com", 0)] * 60 + [("m.good.com", 0)] * 30 + [("few.good.com", 1)]
    outcomes = spark.createDataFrame(marks, "host string, bad int")
    hosts = spark.createDataFrame([("a.spam.com",), ("new.spam.com",), ("www.good.com",), ("few.good.com",), ("other.net",)], "host string")
    found = {r["host"]: r for r in urls.reputation(outcomes, hosts).withColumn("low", urls.lower_bound(1.645)).collect()}
    assert found["new.spam.com"]["mean"] > 0.7
    assert found["few.good.com"]["low"] < found["a.spam.com"]["low"]  # one page proves less than forty
    assert found["a.spam.com"]["low"] > 0.5 and found["www.good.com"]["low"] < 0.1
    assert 0.2 < found["other.net"]["mean"] < 0.8 and found["other.net"]["n"] == 0


# 5 ------------------------------------------------------------------------------------------


def test_jaccard_query(spark):
    want = linked(pairs(queries.table(spark, SF, "documents")))
    assert any(i != c for i, _, c in want)
    same(tuples(queries.op5_divide_skip(spark, SF)), want)


def test_jaccard_cases(spark, docs, none):
    same(tuples(jaccard.join(docs)), linked(pairs(docs)))
    assert jaccard.join(none).count() == 0
    twice = docs.union(docs).unionByName(docs.where("doc_id in (9, 4)").withColumn("doc_id", F.lit(None).cast("long")))
    got = tuples(jaccard.join(twice))
    want = linked(pairs(docs))
    same(got, want + want + [(None, 0, None), (None, 1, 9)])


def test_jaccard_chains_without_leaders(spark, monkeypatch):
    """A chain of near copies, ends far apart, and a pair that only a short list finds."""
    base = [f"t{i}" for i in range(120)]
    rows = [(i, " ".join(base[: 120 - 4 * i] + [f"n{j}" for j in range(4 * i)])) for i in range(12)]
    chain = spark.createDataFrame(rows, "doc_id long, text string")
    want = linked(rows)
    same(tuples(jaccard.join(chain)), want)
    assert {c for _, _, c in want} == {0}
    monkeypatch.setattr(jaccard, "leader_pairs", lambda sets: sets.select(F.col("class").alias("a"), F.col("class").alias("b")).where("false"))
    same(tuples(jaccard.join(chain)), want)  # the merge alone is complete


# 6 ------------------------------------------------------------------------------------------


def test_repeats_query(spark):
    want = without_repeats(pairs(queries.table(spark, SF, "documents")))
    assert any(w[2] for w in want)
    same(tuples(queries.op6_debruijn_spans(spark, SF)), want)


def test_repeats_cases(spark, docs, none):
    more = spark.createDataFrame([(None, A), (12, A + " " + A), (12, "before " + A), (0, "x " + " ".join(A.split()[10:30]))], "doc_id long, text string")
    both = docs.select("doc_id", "text", F.col("n_words").alias("length")).union(more.withColumn("length", F.lit(1)))
    same(tuples(debruijn.remove_repeats(both)), without_repeats(pairs(both)))
    assert debruijn.remove_repeats(none).count() == 0


def test_paths_are_joined_across_buckets(spark):
    rows = [(1, "a b " + A), (2, A + " z"), (3, "q " + A)]
    found = tuples(debruijn.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).drop("key", "twin", "source_key", "source_twin"))
    assert found == [(2, 0, 28, 1, 2), (3, 1, 28, 1, 2)]


def test_colliding_windows_are_verified(spark, monkeypatch):
    monkeypatch.setattr(debruijn, "HASH_BYTES", 1)  # a shared bucket and byte: collisions abound
    rows = [(i, " ".join(f"k{i}_{j}" if i < 3 else f"k3_{j}" for j in range(400))) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = debruijn.remove_repeats(df).collect()
    assert {r["doc_id"]: r["n_removed"] for r in found if r["doc_id"] < 4} == {0: 0, 1: 0, 2: 0, 3: 0}


# 7 ------------------------------------------------------------------------------------------

HTML = [
    (None, ""), ("", ""), ("plain <b>text</b> &amp;lt; 1 < 2", "plain text &lt; 1 < 2"), ("<!-- never closed", ""), ("<script>var a = '<p>x</p>'", ""),
    ('<body><nav><a title="a > b" href=x>menu</a></nav><article><h1>Title</h1><p>One, two\n three.<br><p>Four &eacute;, &#53;.</article><footer>f</footer>', "Title\n\nOne, two three.\n\nFour é, 5."),
    ('<div class="cookie-notice">We use cookies, a lot, you know. Really, many.</div><div class=content><p>Long enough text, of the article.</p><p>End.</p><ul><li>one<li>two</ul></div><div id="comments"><p>First, I say. And more, and more.</p></div>', "Long enough text, of the article.\n\nEnd.\n\none\n\ntwo"),
    ("<main><header><h1>Head</h1></header><p>Text, and more text here.</p><aside>side</aside><form>f<p>g</p></form></main><header>Site</header>", "Head\n\nText, and more text here."),
]


def test_main_text_cases(spark):
    pages = spark.createDataFrame([(i, h, 5) for i, (h, _) in enumerate(HTML)], "page_id int, html string, n_chars int")
    pages = pages.union(pages.where("page_id = 5"))
    found = tagpaths.extracted(pages)
    assert found.columns == ["page_id", "html", "text", "n_chars"]
    got = {r["page_id"]: r["text"] for r in found.collect()}
    assert got == {i: want for i, (_, want) in enumerate(HTML)}
    assert tagpaths.extracted(pages.where("false")).count() == 0
    deep = "<div>" * 3000 + "text, deep. " * 5000
    assert tagpaths.main_text(deep).startswith("text, deep.")


P = "<p>" + "A long paragraph, with commas, and stops. Many words, said here. " * 5 + "</p>"
PT = P[3:-4].strip()
WHOLE = [
    (f"<article><h1>T</h1><div class=body>{P * 4}</div></article>", ["T", *[PT] * 4]),
    (f"<article><section>{P * 6}</section><section>{P}<ul><li>one</ul></section></article>", [*[PT] * 7, "one"]),
    (f"<article><h1>T</h1><p>Before.</p><blockquote>{P * 6}</blockquote><p>After.</p></article>", ["T", "Before.", *[PT] * 6, "After."]),
    (f"<body><nav>menu</nav><p>Before.</p><blockquote><div>{P * 6}</div></blockquote><p>After.</p></body>", ["Before.", *[PT] * 6, "After."]),
    (f"<article><p>Before.</p><table><tr><td>{P * 6}</td><td>cell</td></tr></table></article>", ["Before.", *[PT] * 6, "cell"]),
    (f"<div><section>{P * 6}</section><section><ul><li>one</ul></section></div><footer>x</footer>", [*[PT] * 6, "one"]),
    (f"<div class=post><h1>T</h1><div class=body>{P * 4}</div></div><footer>x</footer>", ["T", *[PT] * 4]),
    (f"<body><h1>Site</h1><main><h1>T</h1><article>{P * 4}</article></main></body>", ["T", *[PT] * 4]),
    (f"<body><h1>Site</h1><article>{P * 4}</article></body>", [PT] * 4),
]


@pytest.mark.parametrize("page, blocks", WHOLE)
def test_main_text_is_the_whole_article(page, blocks):
    assert tagpaths.main_text(page) == "\n\n".join(blocks)


LINKS = "<div>" + " | ".join(f"<a href=/{i}>Page {i}</a>" for i in range(8)) + "</div>"
TOC = "<ul>" + "".join(f"<li><a href=#{i}>Part {i}</a>" for i in range(5)) + "</ul>"
RATIOS = [
    (f"<body>{LINKS}<div class=x>{P * 4}</div><div>{LINKS}</div><div>Short line</div></body>", [PT] * 4),
    (f"<body>{LINKS}<div class=x><h1>T</h1>{P * 4}<p>End.</p></div>{LINKS}</body>", ["T", *[PT] * 4, "End."]),
    (f"<body><div><div>One</div><div>Two</div></div><section>{P * 3}</section></body>", [PT] * 3),
    (f"<article><h1>T</h1>{TOC}{P * 4}<p><a href=1>One</a> link.<h2><a href=2>Two</a></h2>{P}</article>", ["T", *[PT] * 4, "One link.", "Two", PT]),
]


@pytest.mark.parametrize("page, blocks", RATIOS)
def test_ratios_select_the_text(page, blocks, monkeypatch):
    """Without classes and names the ratios of paths decide: where they are equal, the text is another."""
    assert tagpaths.main_text(page) == "\n\n".join(blocks)
    monkeypatch.setattr(tagpaths, "fused_ratios", lambda nodes: np.ones(len(nodes)))
    assert tagpaths.main_text(page) != "\n\n".join(blocks)


MB = 1 << 20
HARD = [
    "<a " * (MB // 3), "<div>" * (MB // 5), "<div>x" * (MB // 6), "<p><b>x" * (MB // 7), "<header>" * (MB // 8) + "x", "<div>" * (MB // 12) + "</main>" * (MB // 12),
    "<section>x" * (MB // 10), '<a href="x>' + "<p>y</p>" * (MB // 8), '<a x=">"' * (MB // 8), "<a '<b \"" * (MB // 8), "</script " * (MB // 9), "<script>" + "</script " * (MB // 9),
    "<!-" * (MB // 3), "&#" + "9" * MB + ";", "<li>x" * (MB // 5), "<table><td>x" * (MB // 12), '<p class="' + "ad-x" * (MB // 4), "<h1>" * (MB // 8) + "x", "<" * MB, "<blockquote>x" * (MB // 13),
]


def test_hard_pages_take_linear_time():
    for page in HARD:
        began = time.process_time()
        tagpaths.main_text(page)
        assert time.process_time() - began < 20, page[:20]
    assert tagpaths.main_text('<p>a</p><a href="x>b</a><p>c</p>') == "a\n\nb\n\nc"
    assert tagpaths.main_text("<p title=it's>a &#65; &#00000000000065; &#x0000000041; &#" + "9" * 9000 + ";b <c") == "a A A A \ufffdb <c"


def test_main_text_query(spark):
    pages = {r["page_id"]: r["html"] for r in queries.table(spark, SF, "pages").collect()}
    found = queries.op7_tag_paths(spark, SF).collect()
    assert len(found) == len(pages)
    for r in found:
        article = pages[r["page_id"]].split("<article>")[1].split("</article>")[0]
        assert r["n_chars"] == len(r["text"]) > 0 and "©" not in r["text"]
        assert r["text"].count("\n\n") + 1 >= article.count("</p>")


# 8 ------------------------------------------------------------------------------------------


def check_shards(rows, n):
    counts = collections.Counter(r["shard"] for r in rows)
    assert not rows or set(counts.values()) <= {len(rows) // n, -(-len(rows) // n)}
    for shard in counts:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(counts[shard]))


def test_shards_query(spark):
    found = queries.op8_fraction_interleave(spark, SF).collect()
    check_shards(found, 40)
    texts = dict(pairs(queries.table(spark, SF, "documents")))
    for r in found:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 16, zlib.crc32(data))


@pytest.mark.parametrize("cell", [ranking.CELL_ROWS, 3])
def test_shards_match_the_mixture(spark, docs, none, monkeypatch, cell):
    monkeypatch.setattr(ranking, "CELL_ROWS", cell)
    rows = spark.range(600).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 7 == 0, None).otherwise("b").alias("source"))
    found = sharding.interleave(rows, 10).collect()
    check_shards(found, 10)
    totals = collections.Counter(r["source"] for r in found)
    for (shard, source), n in collections.Counter((r["shard"], r["source"]) for r in found).items():
        assert abs(n - totals[source] / 10) <= 2
    twice = docs.union(docs).union(docs.where("doc_id = 1"))
    placed = sharding.shard_rows(twice, 4)
    check_shards(placed.collect(), 4)
    assert placed.count() == 2 * docs.count() + 1
    assert sharding.shard_rows(none, 4).count() == 0


def test_shards_keep_columns(spark):
    names = ("_id", "_source", "_hash", "_number", "_mine", "_copy", "_copy_no", "_h", "id", "size")
    rows = spark.range(50).select(
        (F.col("id") % 7).alias("doc_id"), F.when(F.col("id") == 3, F.expr("repeat('y', 2000000)")).otherwise("t").alias("text"), F.lit("s").alias("source"),
        *[F.lit(i).alias(c) for i, c in enumerate(names)],
    )
    out = sharding.shard_rows(rows, 4)
    assert out.columns == [*rows.columns, "shard", "slot"]
    found = out.collect()
    check_shards(found, 4)
    assert len(found) == 50 and {tuple(r[3:13]) for r in found} == {tuple(range(10))} and max(len(r["text"]) for r in found) == 2_000_000


# 9 ------------------------------------------------------------------------------------------

RECORDS = [
    ('{"messages":[{"role":"user","content":"a <|end|> \\\\ b"},{"role":"assistant","content":"c </s>"}]}', "messages", [("user", "a <|end|> \\ b"), ("assistant", "c </s>")]),
    ('{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":null}]}', "conversations", [("user", "q"), ("assistant", "")]),
    ('{"instruction":"do","input":"","output":"done"}', "instruction-input", [("user", "do"), ("assistant", "done")]),
    ('{"input":"it","output":"done","instruction":"do"}', "instruction-input", [("user", "do\n\nit"), ("assistant", "done")]),
    ('{"prompt":"p","completion":"[INST] x [/INST] \\\\[INST]"}', "prompt-completion", [("user", "p"), ("assistant", "[INST] x [/INST] \\[INST]")]),
    ('{"data":{"messages":[{"role":"","content":"\\n"}]}}', "nested-data", [("", "\n")]),
    ('{"messages":[]}', "unknown", None), ("not json", "unknown", None), (None, "unknown", None), ('{"a":1}', "unknown", None),
]


def test_layouts_and_round_trip(spark):
    df = spark.createDataFrame([(i, r, 1) for i, (r, _, _) in enumerate(RECORDS)], "id int, record string, layout int")
    out = chat.formatted(chat.canonical(df)).withColumn("back", chat.read_back()).withColumn("learned", chat.under_mask())
    for r in out.collect():
        _, layout, turns = RECORDS[r["id"]]
        assert r["layout"] == layout
        if turns is None:
            assert r["turns"] is None
            continue
        assert [tuple(t) for t in r["turns"]] == turns == [tuple(t) for t in r["back"]]
        assert r["learned"] == "".join(t for role, t in turns if role == "assistant")
        inner = r["formatted"].replace(chat.START, "").replace(chat.MESSAGE, "").replace(chat.END, "")
        assert not any(c in inner for c in ("<|", "</s>", "[INST]", "[/INST]"))
    assert chat.canonical(df.where("false")).count() == 0


def test_rows_of_conversations(spark):
    rows = [(1, 1, "assistant", "x" * 300_000), (1, 0, None, "q"), (2, 0, "user", None), (None, 0, "user", "n"), (2, 0, "user", None), (3, 5, "system", "é😀")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("record", F.lit(1))
    out = {r["conv_id"]: r for r in chat.formatted(chat.canonical(chat.records_of_rows(df))).withColumn("back", chat.read_back()).collect()}
    assert [tuple(t) for t in out[1]["back"]] == [("", "q"), ("assistant", "x" * 300_000)]
    assert [tuple(t) for t in out[2]["back"]] == [("user", ""), ("user", "")]
    assert [tuple(t) for t in out[None]["back"]] == [("user", "n")] and [tuple(t) for t in out[3]["back"]] == [("system", "é😀")]


def test_long_turns(spark):
    """Neither a turn longer than a JSON string may be nor a conversation over 128 MiB is lost."""
    long = 20_000_001
    rows = [(1, 0, "human", "q"), (1, 1, "assistant", "x"), (2, 0, None, None), *((3, i, "user", "x") for i in range(7))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumn("text", F.when(F.col("text") == "x", F.expr(f"repeat('x', {long})")).otherwise(F.col("text")))
    turns = chat.canonical_rows(df)
    sizes = F.transform("turns", lambda t: F.struct(t["role"], F.length(t["text"])))
    got = {r["conv_id"]: (r["layout"], [tuple(t) for t in r["t"]]) for r in turns.select("conv_id", "layout", sizes.alias("t")).collect()}
    assert got == {1: ("messages", [("human", 1), ("assistant", long)]), 2: ("messages", [("", 0)]), 3: ("messages", [("user", long)] * 7)}
    loss = chat.formatted(turns.where("conv_id = 1")).select("loss").first()["loss"]
    assert [s["length"] for s in loss] == [long]
    records = chat.records_of_rows(df.where("conv_id = 1"))
    with pytest.raises(Exception, match="characters cannot be read"):
        chat.canonical(records).select("layout").collect()
    few = spark.createDataFrame([("not json",), (None,)], "record string")
    assert {r["layout"] for r in chat.canonical(few).collect()} == {"unknown"}


def test_rows_dealt_over_layouts(spark):
    """Every layout gives a conversation back as it was, its roles too; names of columns do not matter."""
    talks = [
        [("user", "p <|end|>"), ("assistant", "q \\")], [("system", "s"), ("user", ""), ("assistant", None)], [("human", "3"), ("gpt", "1")],
        [("user", "u")], [(None, None)], [("assistant", "0"), ("user", "0"), ("assistant", "1")], [("bot", "x"), ("model", "y"), ("prompter", "z"), ("user", "w")],
    ]
    rows = [(100 * n + i, t, role, text) for n in range(12) for i, talk in enumerate(talks) for t, (role, text) in enumerate(talk)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    out = chat.canonical_rows(df, deal=F.floor(F.col("conv_id") / 100)).withColumns({c: F.lit(7) for c in ("_parts", "_variant", "_print", "_said")})
    found = chat.formatted(out).withColumn("back", chat.read_back()).withColumn("learned", chat.under_mask()).collect()
    assert len(found) == 12 * len(talks) and all(r["_parts"] == r["_variant"] == 7 for r in found)
    seen = collections.defaultdict(set)
    for r in found:
        talk = [(role or "", text or "") for role, text in talks[r["conv_id"] % 100]]
        assert [tuple(t) for t in r["turns"]] == talk == [tuple(t) for t in r["back"]], r["layout"]
        assert r["learned"] == "".join(text for role, text in talk if role == "assistant")
        seen[r["conv_id"] % 100].add(r["layout"])
    lists = {m.name for m in chat.MAPPINGS if m.turns}
    assert seen[2] == seen[6] == lists and seen[1] == lists | {"system-instruction"}
    assert seen[0] == {m.name for m in chat.MAPPINGS} - {"system-instruction"}
    clash = spark.createDataFrame([('{"prompt":"p","completion":"c"}', "kept")], "record string, _variant string")
    assert chat.canonical(clash).first()["_variant"] == "kept" and chat.canonical_rows(df.where("false")).count() == 0


# 10 -----------------------------------------------------------------------------------------


def test_ids_at_the_end_of_their_range(spark):
    """The largest id is not a missing one, and texts of rows without an id are told apart."""
    last, text = 2**63 - 1, lambda c, n=30: " ".join(f"{c}{i}" for i in range(n))
    rows = [(1, text("a")), (last, text("a")), (None, text("a")), (None, text("b")), (last, text("c")), (None, text("c")), (None, ""), (last, None)]
    rows += [(None, text(f"n{i}x")) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = collections.Counter((r["doc_id"], r["n_removed"]) for r in debruijn.remove_repeats(df).collect())
    assert got == {(1, 0): 1, (last, 30): 1, (None, 30): 1, (last, 0): 2, (None, 0): 303}
    linked_rows = collections.Counter((r["doc_id"], r["component_id"]) for r in jaccard.join(df).collect())
    assert linked_rows == {(1, 1): 1, (last, 1): 1, (None, 1): 1, (last, last): 2, (None, last): 1, (None, None): 302}


def test_number_tables_stay(spark):
    """Lines of numbers, and words with digits, differ from document to document."""
    row = lambda i, j: " ".join(str(1000 * i + 10 * j + c) for c in range(6))
    rows = [(i, "\n".join(row(i, j) for j in range(12)), "h") for i in range(30)]
    rows += [(100 + i, "\n".join(f"item{i}x{j} costs {i}.{j} each" for j in range(12)), "h") for i in range(30)]
    rows += [(200 + i, f"page {i} of 30\n" + " ".join(f"w{i}x{j}" for j in range(60)), "h") for i in range(30)]
    got = {r["doc_id"]: r for r in lines.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i]["kept"] and got[i]["n_left_words"] == 72 for i in range(30))
    assert all(got[100 + i]["n_left_words"] == 48 for i in range(30))
    assert all(got[200 + i]["kept"] and got[200 + i]["n_left_words"] == 60 for i in range(30))  # page numbers do not count
    forms = ["Page  12 of 9", "12 13", "a 1 2 3 b 4", "x1 2y", "é 5", "7"]
    df = spark.createDataFrame([(f,) for f in forms], "l string").select(lines.normalised(F.col("l")))
    assert [r[0] for r in df.collect()] == ["page 0 of 0", "12 13", "a 0 0 0 b 0", "x1 2y", "é 0", "7"]


def test_line_rules(spark, docs, none):
    limits = lines.Limits(min_words=3, min_docs=2, max_share=0.5, min_left=0.6)
    text = lambda i: f"Page {i} of 9\n" + " ".join(f"word{i}{j}x" for j in "abcdef")
    rows = [(i, text(i), "h") for i in range(5)] + [(5, "page 7 of 9\nonly two", "h"), (6, "a b c " * 4, "h"), (7, text(1), "h"), (8, "Page 1 of 9\nnot so many here", None), (9, None, "h"), (10, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("h", F.lit(1))
    got = {r["doc_id"]: r for r in lines.judge(df, limits).collect()}
    assert [got[i]["n_left_words"] for i in range(5)] == [6] * 5 and all(got[i]["kept"] for i in range(5))
    assert (got[5]["n_left_words"], got[5]["kept"], got[5]["base_failed"]) == (2, False, False)
    assert got[6]["n_repeat_words"] == 12 and got[6]["base_failed"]
    assert got[8]["n_left_words"] == 8 and got[8]["kept"]
    assert all(got[i]["base_failed"] and got[i]["n_words"] == 0 for i in (9, 10))
    measures = lines.measured(df, "doc_id", "source", "text")
    cleaned = {r["doc_id"]: r["text"] for r in lines.without_lines(df, lines.boilerplate(measures, limits)).collect()}
    assert cleaned[1] == text(1).split("\n")[1] and cleaned[8] == rows[8][1] and cleaned[9] is None
    assert lines.judge(none).count() == 0 and lines.judge(docs).count() == docs.count()
