"""Named slices of one table, all taken in one scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Slice:
    folder: str
    name: str
    where: Column | None = None


def organism_slice_name(key: str) -> tuple[str, str]:
    """Folder and name of an organism slice: ``a_b`` and plain ``a`` keys differ."""
    organism, _, rest = key.partition("_")
    kind = rest.split("_")[0] if rest else "core"
    return organism, f"{organism}_canonical_{kind}"


def option_filter(options: Mapping[str, str], filters: Mapping[str, Column]) -> Column | None:
    """All given options combined; an option that is absent asks nothing.

    ``filters`` holds, per option, either the column to compare with the option's value or,
    for switches (``exclude_x``, ``only_x``), the condition itself.
    """
    conditions = [
        filters[name] if name.startswith(("exclude_", "only_")) else filters[name] == F.lit(value)
        for name, value in sorted(options.items())
    ]
    return reduce(lambda a, b: a & b, conditions) if conditions else None


def slice_export(df: DataFrame, slices: Sequence[Slice]) -> DataFrame:
    """Each row once per slice it belongs to, with the slice's ``folder`` and ``name``.

    A narrow step: the table is read once however many slices there are, and a slice that holds
    most rows stays spread over the tasks that read them. Rows of no slice are left out by a
    filter that can reach the scan.
    """
    conditions = [s.where for s in slices if s.where is not None]
    if len(conditions) == len(slices):
        df = df.where(reduce(lambda a, b: a | b, conditions))
    tags = [
        F.when(
            F.lit(True) if s.where is None else s.where,
            F.struct(F.lit(s.folder).alias("folder"), F.lit(s.name).alias("name")),
        )
        for s in slices
    ]
    return (
        df.withColumn("_slice", F.explode(F.array(*tags)))
        .where(F.col("_slice").isNotNull())
        .withColumns({"folder": F.col("_slice.folder"), "name": F.col("_slice.name")})
        .drop("_slice")
    )


def visibility_split(df: DataFrame, is_private: Column) -> DataFrame:
    """Notes tagged ``public`` or ``private``; a note whose flag is NULL is private."""
    private = F.coalesce(is_private, F.lit(True))
    return df.withColumn("visibility", F.when(private, "private").otherwise("public"))
