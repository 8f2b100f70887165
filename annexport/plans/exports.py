"""Running several exports, each on its own, with one report for all."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from annexport.sources.rows import known_rows

REPORT_SCHEMA = "name string, status string, row_count long, error string"
DONE, FAILED = "done", "failed"


@dataclass(frozen=True)
class Export:
    """``build`` gives the rows, ``write`` stores them at ``path``."""

    name: str
    build: Callable[[], DataFrame]
    write: Callable[[DataFrame, str], None]
    path: str


class ExportError(RuntimeError):
    """Some exports failed; the others are complete."""


def run_export(export: Export) -> tuple[str, str, int | None, str | None]:
    """Rows are counted by the writing job itself, so nothing is read twice."""
    try:
        seen = Observation()
        rows = export.build().observe(seen, F.count(F.lit(1)).alias("row_count"))
        export.write(rows, export.path)
        return export.name, DONE, int(seen.get["row_count"]), None
    except Exception as error:  # one table's failure must not stop the others
        return export.name, FAILED, None, f"{type(error).__name__}: {error}".splitlines()[0]


def export_tables(
    spark: SparkSession, exports: Sequence[Export], on_violation: str = "fail", at_once: int = 4
) -> DataFrame:
    """``name, status, row_count, error`` per export, by name.

    Several jobs are submitted at once so that small tables do not leave the cluster idle.
    Under ``fail`` a failure is raised, but only after all exports have had their turn.
    """
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        outcomes = sorted(pool.map(run_export, exports))
    failed = [f"{name}: {error}" for name, status, _, error in outcomes if status == FAILED]
    if failed and on_violation == "fail":
        raise ExportError("; ".join(failed))
    return known_rows(spark, outcomes, REPORT_SCHEMA)
