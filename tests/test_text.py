"""Scalar expressions against written-out tables of inputs and results."""

import pytest
from pyspark.sql import functions as F

from archiveloom.functions import files as fx
from archiveloom.functions import text as tx
from archiveloom.sources import landing as ld


def apply(spark, values, *expressions):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    out = df.select("i", *[e(F.col("v")).alias(f"c{n}") for n, e in enumerate(expressions)])
    return [tuple(r)[1:] for r in sorted(out.collect(), key=lambda r: r.i)]


# text: URL key, DOI key, title key, trimmed, trimmed at the end
KEYS = {
    None: (None, None, None, None, None),
    "": (None, None, None, "", ""),
    " ": (None, None, None, "", ""),
    "　x　": ("x", "x", "x", "x", "　x"),
    "\x1c": (None, None, None, "", ""),
    "\tA\n": ("a", "a", "a", "A", "\tA"),
    "a//": ("a", "a//", "a//", "a//", "a//"),
    "a/ /": ("a/ ", "a/ /", "a/ /", "a/ /", "a/ /"),
    "///": (None, "///", "///", "///", "///"),
    "  A  B C ": ("a  b c", "a  b c", "a b c", "A  B C", "  A  B C"),
    "ÄÖ Straße": ("äö straße", "äö straße", "äö straße", "ÄÖ Straße", "ÄÖ Straße"),
    "HTTP://X/": ("http://x", "http://x/", "http://x/", "HTTP://X/", "HTTP://X/"),
    " http://x/ ": ("http://x", "http://x/", "http://x/", "http://x/", " http://x/"),
    "a\n/": ("a\n", "a\n/", "a /", "a\n/", "a\n/"),
    "é\x85è": ("é\x85è", "é\x85è", "é è", "é\x85è", "é\x85è"),
}


def test_keys(spark):
    got = apply(spark, list(KEYS), tx.url_key, tx.doi_key, tx.title_key, tx.strip, tx.rstrip)
    assert dict(zip(KEYS, got)) == KEYS


# text: slug, shortened to 34 characters
SLUGS = {
    None: (None, None),
    "": ("", ""),
    "Field notes, 2nd ed.": ("field-notes-2nd-ed", "Field notes, 2nd ed."),
    "--A--": ("a", "--A--"),
    "ÄÖ Straße": ("stra-e", "ÄÖ Straße"),
    "y" * 34: ("y" * 34, "y" * 34),
    "z" * 35: ("z" * 35, "z" * 33 + "…"),
    "q" * 32 + "  w w": ("q" * 32 + "-w-w", "q" * 32 + "…"),
}


def test_slug_and_shorten(spark):
    assert dict(zip(SLUGS, apply(spark, list(SLUGS), tx.slug, tx.shorten))) == SLUGS


# declared type, file name, extension, counts as content, words of the stem
FILES = [
    (None, None, "", False, None), (None, "", "", False, []), (None, "noext", "", False, ["noext"]),
    (None, "a.b.TXT", "txt", True, []), (None, "end.", "", False, ["end"]), (None, ".DS_Store", "ds_store", False, []),
    (None, "Thumbs.db", "db", False, ["Thumbs"]), (None, " spaced .Pdf ", "pdf", True, ["spaced"]),
    (None, "x.tar.gz", "gz", True, ["tar"]), (None, "desktop.INI", "ini", False, ["desktop"]),
    ("", "my_field-notes 2.docx", "docx", True, ["field", "notes"]), (" ", "a.csv", "csv", True, []),
    ("..PDF", "noext", "pdf", True, ["noext"]), (" . ", "a.txt", "txt", True, []), ("unknown", "a.txt", "unknown", True, []),
    (".docx ", None, "docx", True, None), ("a.b", "interview.txt", "a.b", True, ["interview"]), ("tmp", "keep.pdf", "tmp", False, ["keep"]),
    ("pdf", "Thumbs.db", "pdf", False, ["Thumbs"]), ("LOG", "x", "log", False, []), (None, "a.lock", "lock", False, []),
]


def test_file_extension_and_content(spark):
    df = spark.createDataFrame([(i, t, n) for i, (t, n, *_) in enumerate(FILES)], "i int, t string, n string")
    out = df.select(
        "i", fx.file_extension("t", "n").alias("ext"), fx.counts_as_content("t", "n").alias("content"),
        fx.stem_tokens("n").alias("tokens"),
    )
    got = {r.i: (r.ext, r.content, r.tokens) for r in out.collect()}
    assert {FILES[i][:2]: g for i, g in got.items()} == {f[:2]: f[2:] for f in FILES}


# label: file name, type
LABELS = {
    "Report: (é) #1": ("Report é 1.pdf", "unknown"),
    "a/b.CSV ": ("ab.CSV", "csv "),
    "  ": (".pdf", "unknown"),
    "plain": ("plain.pdf", "unknown"),
    "notes_v1.2-final.docx": ("notes_v1.2-final.docx", "docx"),
}


def test_names_of_links_and_resources(spark):
    assert dict(zip(LABELS, apply(spark, list(LABELS), fx.safe_file_name, fx.type_of_label))) == LABELS
    df = spark.createDataFrame([("", "t", 5), (None, "", 5), ("f", "t", 5)], "f string, t string, i int")
    assert [r[0] for r in df.select(fx.resource_name("f", "t", "i")).collect()] == ["t", "file_5", "f"]
    df = spark.createDataFrame([("", "/a/b/9"), ("n", "/a/b/9")], "c string, u string")
    assert [r[0] for r in df.select(fx.link_name("c", "u")).collect()] == ["9", "n"]


@pytest.mark.parametrize(
    "text,expected",
    [("Version 03", 3.0), ("v2 (public)", 2.0), ("final", None), (None, None), ("rev v 0010.", 10.0), ("version 000", 0.0)],
)
def test_version_number(spark, text, expected):
    assert apply(spark, [text], ld.version_number)[0][0] == expected


def test_doi_forms(spark):
    got = apply(spark, ["see https://doi.org/10.1/x, ok", "none", None], ld.doi_in_citation)
    assert [r[0] for r in got] == ["https://doi.org/10.1/x,", None, None]
    assert apply(spark, ["doi:10.7/AB", "10.7/AB"], ld.doi_of_identifier) == [
        ("https://doi.org/10.7/AB",), ("https://doi.org/10.7/AB",)
    ]


def test_unknown_label(spark):
    df = spark.createDataFrame([("a", 1), (None, 7), (None, None)], "l string, i long")
    assert [r[0] for r in df.select(tx.unknown_label("l", "i")).collect()] == ["a", "unknown (7)", "unknown (None)"]
