"""CSV text as column expressions, for records whose width differs from row to row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A field is quoted when it holds a separator, a quote or a line end, starts with
# white space, or is the two characters \. (an end-of-data mark for some readers).
NEEDS_QUOTES = r'(?U)[,"\r\n]|^\s|^\\\.$'


def csv_quote(value: Column) -> Column:
    """One field: NULL becomes the empty string, quotes are doubled."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike(NEEDS_QUOTES), quoted).otherwise(text)


def csv_line(fields: Column) -> Column:
    """One record from an array of strings of any length."""
    return F.array_join(F.transform(fields, csv_quote), ",")
