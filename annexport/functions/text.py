"""Rendering and normalising of scalar values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def prefixed_id(value: Column, prefix: str, width: int) -> Column:
    """``DBP%07d`` style ids; ids wider than the padding are kept whole, NULL stays NULL."""
    padded = F.format_string(f"{prefix.replace('%', '%%')}%0{width}d", value.cast("long"))
    return F.when(value.isNotNull(), padded)


def timestamp_text(value: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``. The cast prints a zoneless timestamp as it stands, so the text
    does not depend on the session time zone; the cut drops the fraction of a second."""
    return F.substring(value.cast("string"), 1, 19)


def normalise_lines(value: Column) -> Column:
    """CRLF and CR become LF, and one final line end is dropped."""
    unified = value
    for line_end in ("\r\n", "\r"):
        unified = F.replace(unified, F.lit(line_end), F.lit("\n"))
    return F.regexp_replace(unified, r"\n\z", "")


def clean_name(value: Column) -> Column:
    """Keep letters of the English alphabet, digits and underscore (this also trims)."""
    return F.regexp_replace(value, "[^a-zA-Z0-9_]", "")


def export_file_name(table: Column) -> Column:
    """File an export of a table's long text columns goes to."""
    return F.concat(F.lower(table), F.lit("_clob_data.csv"))


def decoded_path(uri: Column) -> Column:
    """A file's path with the characters its URI spells as ``%20`` and the like."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def split_file_name(path: Column, suffix: str) -> Column:
    """Name of a split output: the base name up to its first dot, then the suffix.
    ``/x/a.b.gff3`` with ``_poly`` gives ``a_poly.gff3``."""
    base = F.substring_index(path, "/", -1)
    return F.concat(F.substring_index(base, ".", 1), F.lit(f"{suffix}.gff3"))
