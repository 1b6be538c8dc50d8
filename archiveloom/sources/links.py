"""Download links from landed HTML pages."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archiveloom.functions.files import link_name
from archiveloom.functions.text import blank_to_null, strip

# What is no markup: comments, scripts and styles.
_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
# Attributes of a tag: quoted values may hold ">"; a stray quote is a character like others.
_ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+"""
# An anchor with its attributes (group 1) and its content (group 2), closed or not.
_ANCHOR = rf"(?is)<a\b({_ATTRIBUTES})>(.*?)(?=</a|<a\b|\z)"
# The value of an attribute in double quotes, single quotes or none.
_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_REFERENCE = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def _named_references() -> Column:
    """Names of character references, from Python's table of HTML entities."""
    pairs = sorted(name2codepoint.items()) + [("apos", 39)]
    return F.create_map(*[F.lit(x) for name, code in pairs for x in (name, chr(code))])


def _character(reference: Column) -> Column:
    """The character ``&...;`` stands for; the reference itself when it is none."""
    name = F.substring(reference, 2, 1 << 20)
    name = F.substring_index(name, ";", 1)
    decimal = F.regexp_extract(name, "^#([0-9]+)$", 1).try_cast("int")
    hexadecimal = F.conv(F.nullif(F.regexp_extract(name, "^#[xX]([0-9a-fA-F]+)$", 1), F.lit("")), 16, 10).try_cast("int")
    code = F.coalesce(decimal, hexadecimal)
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    numeric = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).when(code.isNotNull(), F.lit("\ufffd"))
    return F.coalesce(numeric, F.try_element_at(_named_references(), name), reference)


def unescaped(text: Column) -> Column:
    """``text`` with its character references decoded, each once."""
    between = F.split(text, _REFERENCE, -1)
    found = F.transform(F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0)), _character)
    joined = F.zip_with(between, found, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.when(F.contains(text, F.lit("&")), F.array_join(joined, "")).otherwise(text)


def _plain(html: Column) -> Column:
    return unescaped(F.regexp_replace(html, rf"(?s)<{_ATTRIBUTES}>", ""))


def _attribute(attributes: str, name: str) -> Column:
    """Decoded value of an attribute; NULL when it is missing or empty."""
    pattern = rf"(?is)(?:^|\s){name}{_VALUE}"
    return blank_to_null(unescaped(F.concat(*[F.regexp_extract(attributes, pattern, g) for g in (1, 2, 3)])))


def absolute_url(href: Column, base: str | Column) -> Column:
    base = F.lit(base) if isinstance(base, str) else base
    return F.when(F.startswith(href, F.lit("http")), href).otherwise(F.concat(base, href))


def harvest_links(
    pages: DataFrame, base: str | Column, marker: str | Column = "/download/", key: str = "page_id"
) -> DataFrame:
    """(key, download_url, name): anchors whose href contains ``marker``.

    ``marker`` may be an expression over the page, for catalogues whose links name their
    project. The name is the anchor's title, else its text, else the last segment of the URL.
    Of several anchors with the same URL on a page the first one counts. Pages are parsed
    where they lie, each once; only links are shuffled.
    """
    marker = F.lit(marker) if isinstance(marker, str) else marker
    base = F.lit(base) if isinstance(base, str) else base
    anchors = F.regexp_extract_all(F.regexp_replace("html", _HIDDEN, ""), F.lit(_ANCHOR), F.lit(0))
    found = pages.select(key, base.alias("base"), marker.alias("marker"), F.posexplode(anchors).alias("place", "anchor"))
    found = found.select(
        "*", F.regexp_extract("anchor", _ANCHOR, 1).alias("attributes"), F.regexp_extract("anchor", _ANCHOR, 2).alias("content")
    )
    title = _attribute("attributes", "title")
    links = found.withColumn("href", _attribute("attributes", "href")).where(F.contains("href", "marker"))
    named = links.select(
        key, "place",
        absolute_url(F.col("href"), F.col("base")).alias("download_url"),
        F.coalesce(title, strip(_plain(F.col("content")))).alias("name"),
    ).withColumn("name", link_name("name", "download_url"))
    return named.groupBy(key, "download_url").agg(F.min_by("name", "place").alias("name"))
