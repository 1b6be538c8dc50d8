"""Column expressions for text keys and names.

All of them are built-in expressions, so they stay inside whole-stage codegen, and all of
them give NULL (never an error) on NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 characters that count as white space
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_WS_RUN = "[" + WHITESPACE + "]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim Unicode white space on both ends (``trim`` alone only removes blanks)."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def rstrip(c: Column | str) -> Column:
    return F.rtrim(_col(c), F.lit(WHITESPACE))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def collapse_whitespace(c: Column | str) -> Column:
    return strip(F.regexp_replace(_col(c), _WS_RUN, " "))


def url_key(c: Column | str) -> Column:
    """Stripped, without trailing slashes, lower case; NULL when nothing is left."""
    return blank_to_null(F.lower(F.rtrim(strip(c), F.lit("/"))))


def doi_key(c: Column | str) -> Column:
    return blank_to_null(F.lower(strip(c)))


def text_key(c: Column | str) -> Column:
    """White space collapsed, lower case; the identity of titles, names and keywords."""
    return blank_to_null(F.lower(collapse_whitespace(_col(c).cast("string"))))


title_key = text_key


def word_key(c: Column | str) -> Column:
    """:func:`text_key`, without its regular expression for texts that hold no white space at all."""
    c = _col(c).cast("string")
    bare = F.octet_length(F.translate(c, WHITESPACE, "")) == F.octet_length(c)
    return F.when(bare, blank_to_null(F.lower(c))).otherwise(text_key(c))


def slug(c: Column | str) -> Column:
    dashed = F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]+", "-")
    return F.btrim(dashed, F.lit("-"))


def shorten(c: Column | str, limit: int = 34) -> Column:
    """Cut to ``limit`` characters, the last one an ellipsis."""
    c = _col(c)
    cut = F.concat(rstrip(F.substring(c, 1, limit - 1)), F.lit("…"))
    return F.when(F.length(c) > limit, cut).otherwise(c)


def label_or(c: Column | str, default: str) -> Column:
    """``default`` where the label is NULL or empty."""
    return F.coalesce(blank_to_null(c), F.lit(default))


def unknown_label(label: Column | str, key: Column | str) -> Column:
    """A dimension label, or ``unknown (<id>)`` where the lookup found none."""
    shown = F.coalesce(_col(key).cast("string"), F.lit("None"))
    return F.coalesce(_col(label), F.concat(F.lit("unknown ("), shown, F.lit(")")))


def words(c: Column | str) -> Column:
    """Lower-case words of letters and digits, in order."""
    parts = F.split(F.lower(_col(c)), r"[^\p{L}\p{N}]+")
    return F.array_remove(parts, "")
