"""GFF3 line expressions. A line may be short or a comment, so fields are read with ``get``."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The nine GFF3 columns, in file order.
FIELDS = ("seqid", "source", "type", "start", "end", "score", "strand", "phase", "attributes")
ATTRIBUTES = FIELDS.index("attributes")
TYPE = FIELDS.index("type")

REFERENCE_TAG = "Dbxref"


def fields(line: Column) -> Column:
    return F.split(line, "\t", -1)


def field(line: Column, index: int) -> Column:
    """NULL where the line has fewer fields."""
    return F.get(fields(line), F.lit(index))


# One attribute that starts with the tag: the text up to the next separator.
_REFERENCE = rf"(?<![^;]){REFERENCE_TAG}[^;]*"


def other_attributes(attributes: Column) -> Column:
    """Every attribute that is not a reference, each followed by ``;``."""
    return F.regexp_replace(F.concat(attributes, F.lit(";")), _REFERENCE + ";", "")


def reference_attributes(attributes: Column) -> Column:
    """The reference attributes joined with nothing between them."""
    return F.array_join(F.regexp_extract_all(attributes, F.lit(_REFERENCE), F.lit(0)), "")


def _any_of(names: Sequence[str]) -> str:
    return "(?:" + "|".join(re.escape(n) for n in names) + ")"


def listed_references(references: Column, names: Sequence[str]) -> Column:
    """The list after the first tag, led by a comma; NULL when no name occurs in the text at all,
    empty when there is no list. (?d) makes LF the only line end for the dot."""
    if not names:
        return F.lit(None).cast("string")
    return F.when(
        references.rlike(_any_of(names)),
        F.regexp_replace(F.regexp_extract(references, f"(?d){REFERENCE_TAG}=(.+)", 1), r"(?s)\A(?=.)", ","),
    )


def kept_references(references: Column, listed: Column, names: Sequence[str]) -> Column:
    """References without those that start with a name; empty when none is left."""
    if not names:
        return references
    rest = F.regexp_replace(listed, f",{_any_of(names)}[^,]*", "")
    tagged = F.regexp_replace(rest, r"\A,", f"{REFERENCE_TAG}=")
    return F.when(listed.isNull(), references).otherwise(tagged)


def joined_attributes(others: Column, references: Column) -> Column:
    """Other attributes, then references; one closing ``;`` goes when no reference is left."""
    bare = F.regexp_replace(others, r";\z", "")
    return F.when(references == "", bare).otherwise(F.concat(others, references))


def with_attributes(line: Column, attributes: Column) -> Column:
    """The line with its ninth field replaced; fields beyond the ninth stay."""
    before = F.substring_index(line, "\t", ATTRIBUTES)
    length = F.length(F.substring_index(line, "\t", ATTRIBUTES + 1))
    after = F.substring(line, length + 1, F.length(line))
    return F.concat(before, F.lit("\t"), attributes, after)
