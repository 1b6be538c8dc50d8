"""Column expressions over file names and file types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from archiveloom import dimensions as dim
from archiveloom.functions.text import _col, blank_to_null, strip


def file_extension(file_type: Column | str, file_name: Column | str) -> Column:
    """Extension of a file: the declared type without leading dots, else the name's suffix.

    Gives '' when neither names one. A declared ``unknown`` is an extension like any other.
    """
    declared = F.ltrim(F.lower(strip(file_type)), F.lit("."))
    name = _col(file_name)
    suffix = F.substring_index(F.lower(strip(name)), ".", -1)
    return F.coalesce(
        blank_to_null(declared), F.when(F.contains(name, F.lit(".")), suffix), F.lit("")
    )


def is_junk_name(file_name: Column | str) -> Column:
    """True for housekeeping files; false on NULL."""
    clean = F.lower(strip(F.coalesce(_col(file_name), F.lit(""))))
    return clean.isin(*dim.JUNK_FILE_NAMES)


def is_content(ext: Column) -> Column:
    """True for an extension that says something about a project."""
    return (ext != "") & ~ext.isin(*dim.JUNK_EXTENSIONS)


def counts_as_content(file_type: Column | str, file_name: Column | str) -> Column:
    """True when a file takes part in project typing."""
    return ~is_junk_name(file_name) & is_content(file_extension(file_type, file_name))


def type_priority(ext: Column) -> Column:
    """3 analysis-tool file, 2 primary data, 1 anything else."""
    return (
        F.when(ext.isin(*dim.QDA_EXTENSIONS), F.lit(3))
        .when(ext.isin(*dim.PRIMARY_DATA_EXTENSIONS), F.lit(2))
        .otherwise(F.lit(1))
    )


def project_type_of(priority: Column) -> Column:
    """Project type from the highest file priority; NULL (no content file) is no project."""
    return (
        F.when(priority == 3, F.lit("QDA_PROJECT"))
        .when(priority == 2, F.lit("QD_PROJECT"))
        .when(priority == 1, F.lit("OTHER_PROJECT"))
        .otherwise(F.lit("NOT_A_PROJECT"))
    )


def stem_tokens(file_name: Column | str) -> Column:
    """ASCII-letter tokens of three or more letters in a name without its last suffix."""
    stem = F.regexp_replace(_col(file_name), r"\.[^.]*\z", "")
    return F.regexp_extract_all(stem, F.lit("[A-Za-z]{3,}"), F.lit(0))


def safe_file_name(title: Column | str) -> Column:
    """Letters, digits and ``._- `` only; ``.pdf`` is added to a name without a dot."""
    kept = strip(F.regexp_replace(_col(title), r"[^\p{L}\p{N}._\- ]", ""))
    return F.when(F.contains(kept, F.lit(".")), kept).otherwise(F.concat(kept, F.lit(".pdf")))


def type_of_label(label: Column | str) -> Column:
    """Lower-case suffix of a file label, ``unknown`` without a dot."""
    c = _col(label)
    suffix = F.lower(F.substring_index(c, ".", -1))
    return F.when(F.contains(c, F.lit(".")), suffix).otherwise(F.lit("unknown"))


def link_name(cleaned: Column | str, url: Column | str) -> Column:
    """Name of a harvested link: its cleaned title, else the last URL segment."""
    return F.coalesce(blank_to_null(cleaned), F.substring_index(_col(url), "/", -1))


def resource_name(filename: Column | str, title: Column | str, rid: Column | str) -> Column:
    """Name of a catalogue resource: file name, else title, else ``file_<id>``."""
    return F.coalesce(
        blank_to_null(filename),
        blank_to_null(title),
        F.concat(F.lit("file_"), _col(rid).cast("string")),
    )
