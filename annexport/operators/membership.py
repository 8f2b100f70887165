"""NOT IN, NOT EXISTS and lookups that must succeed, as set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_in(
    rows: DataFrame, excluded: DataFrame, column: str, within: Sequence[str] = ()
) -> DataFrame:
    """SQL's ``column NOT IN (SELECT column FROM excluded ...)``, NULL rules included.

    ``within`` names the correlation columns. A row stays when its set is empty, or when its
    value is not NULL, the set holds no NULL, and no value matches. The match is an equality
    anti join on all columns, never a comparison of all pairs within a group, and nothing has
    to be broadcast. The NULL rules are a second one, to the one or two flags of the group, behind
    a shuffle of their own, so that a group with very many rows can be split.
    """
    within = list(within)
    values = excluded.where(F.col(column).isNotNull()).select(*within, column)
    left = rows.join(values, [*within, column], "left_anti")
    if not (rows.schema[column].nullable or excluded.schema[column].nullable):
        return left.select(*rows.columns)
    if within:
        groups = [f"_within_{i}" for i in range(len(within))]
        flags = excluded.select(
            *[F.col(w).alias(g) for w, g in zip(within, groups)], F.col(column).isNull().alias("_is_null")
        ).distinct()
        same = [F.col(w) == F.col(g) for w, g in zip(within, groups)]
        bad = F.col("_is_null") | F.col(column).isNull()
        return left.join(flags, reduce(lambda a, b: a & b, [*same, bad]), "left_anti").select(*rows.columns)
    has_null = F.max(F.col(column).isNull())
    set_has_null = excluded.agg(has_null).scalar()
    return left.where(
        set_has_null.isNull() | (~set_has_null & F.col(column).isNotNull())
    ).select(*rows.columns)


def not_exists(rows: DataFrame, excluded: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows with no partner on a composite key; a NULL key has no partner."""
    return rows.join(excluded.select(*on), list(on), "left_anti")


def lookup_misses(
    rows: DataFrame, lookup: DataFrame, on: str, required: Sequence[str] = ()
) -> DataFrame:
    """``on, row_count`` of the keys the lookup does not have.

    Keys are counted before the join, so only distinct keys are shuffled to it. NULL keys are
    misses too, and so are keys whose entry has no value in a ``required`` column.
    """
    keys = rows.groupBy(on).agg(F.count(F.lit(1)).alias("row_count"))
    return keys.join(lookup.dropna(subset=[on, *required]).select(on), on, "left_anti")


class LookupMissError(ValueError):
    """A value that must be found was not."""


def strict_lookup(
    rows: DataFrame, lookup: DataFrame, on: str, on_violation: str = "fail",
    required: Sequence[str] = (),
) -> DataFrame:
    """Left join to a table that must have every key, with a value in each ``required`` column.

    ``fail`` raises before anything is returned; ``report`` leaves NULLs for the caller to count.
    """
    if on_violation == "fail":
        missing = lookup_misses(rows, lookup, on, required).first()
        if missing is not None:
            wanted = f" with {', '.join(required)}" if required else ""
            raise LookupMissError(f"{on}={missing[on]!r} is not in the lookup table{wanted}")
    return rows.join(lookup, on, "left")


def is_unique(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether the keys identify rows and are never NULL."""
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return repeated.where((F.col("row_count") > 1) | null_key).isEmpty()
