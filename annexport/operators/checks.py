"""Checks of what exports require: before anything is written, or by the job that writes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from annexport.operators.membership import is_unique
from annexport.session import discard, moved, unchecked_path


class RequiredValueError(ValueError):
    """A required value is NULL."""


def required_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, violations``: NULLs per required column, in one pass over ``df``."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "violations")


def require_values(df: DataFrame, columns: Sequence[str], on_violation: str = "fail") -> DataFrame:
    """``df`` itself; under ``fail`` raises when a required value is NULL."""
    if on_violation == "fail":
        bad = required_violations(df, columns).where(F.col("violations") > 0).collect()
        if bad:
            raise RequiredValueError(", ".join(f"{r.column_name}: {r.violations} NULL" for r in bad))
    return df


class RequiredCounts:
    """Counts NULLs in required columns while rows pass through a job that does something else with them."""

    def __init__(self) -> None:
        self.seen: list[Observation] = []

    def of(self, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        """``df``, whose NULLs in ``columns`` are counted by the first job that runs it."""
        self.seen.append(Observation())
        return df.observe(self.seen[-1], *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])

    def violations(self) -> dict[str, int]:
        """The columns with NULLs. Waits for that job."""
        return {c: n for seen in self.seen for c, n in seen.get.items() if n}


def written_if_clean(
    rows: DataFrame, path: str, required: RequiredCounts, write: Callable[[DataFrame, str], None],
    on_violation: str = "fail",
) -> None:
    """Writes ``rows`` once, beside ``path``, and moves them there if nothing required was NULL.

    Under ``fail`` a NULL raises and leaves neither the rows nor anything else at ``path``.
    """
    spark, aside = rows.sparkSession, unchecked_path(path)
    try:
        write(rows, aside)
        bad = required.violations()
        if bad and on_violation == "fail":
            raise RequiredValueError(", ".join(f"{c}: {n} NULL" for c, n in bad.items()))
        moved(spark, aside, path)
    finally:
        discard(spark, aside)


def require_matched(rows: DataFrame, lookup: DataFrame, on: str, column: str) -> None:
    """Raises when a row's entry in ``lookup`` has NULL in ``column``. Rows without an entry pass.

    Only the entries at fault are joined, so the check moves few rows however large both sides are.
    """
    unfit = lookup.where(F.col(column).isNull()).select(on)
    bad = rows.select(on).join(unfit, on, "left_semi").first()
    if bad is not None:
        raise RequiredValueError(f"{column} is NULL for {on}={bad[on]!r}")


def require_unique(df: DataFrame, keys: Sequence[str], name: str) -> None:
    """Raises when the keys do not identify the rows of the table called ``name``."""
    if not is_unique(df, keys):
        raise RequiredValueError(f"{', '.join(keys)} of {name} is NULL or repeated")


def unregistered(inventory: DataFrame, registry: DataFrame, on: str = "table_name") -> DataFrame:
    """Inventory rows whose table has no entry in the registry; case does not matter."""
    known = registry.select(F.lower(on).alias("_known"))
    return inventory.join(known, F.lower(inventory[on]) == F.col("_known"), "left_anti")
