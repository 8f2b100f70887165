"""Clean-up and splitting of GFF3 lines.

Lines have ``file, block, id`` (their position) and ``value``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annexport.functions import gff3
from annexport.functions.text import split_file_name

# The version line of split-off files, and what the two outputs are called.
HEADER_LINE = "##gff-version\t3"
KEPT_SUFFIX = "_no_poly"
SPLIT_SUFFIX = "_poly"


def clean_dbxref(lines: DataFrame, names: Sequence[str]) -> DataFrame:
    """References of the named databases removed; the kept ones move to the end.

    Lines that do not speak of references, and those with fewer than nine fields, pass as they
    are. Works row by row inside one generated stage, so it needs no shuffle and also runs on a
    stream. Each step is a column of its own, so that none is computed more than once per line.
    """
    attributes = F.when(
        F.col("value").contains(gff3.REFERENCE_TAG), gff3.field(F.col("value"), gff3.ATTRIBUTES)
    )
    references, listed = F.col("_references"), F.col("_listed")
    cleaned = gff3.joined_attributes(F.col("_others"), F.col("_kept"))
    return (
        lines.withColumn("_attributes", attributes)
        .withColumn("_references", gff3.reference_attributes(F.col("_attributes")))
        .withColumn("_listed", gff3.listed_references(references, names))
        .withColumns({
            "_others": gff3.other_attributes(F.col("_attributes")),
            "_kept": gff3.kept_references(references, listed, names),
        })
        .withColumn(
            "value",
            F.when(F.col("_attributes").isNull(), F.col("value"))
            .otherwise(gff3.with_attributes(F.col("value"), cleaned)),
        )
        .drop("_attributes", "_references", "_listed", "_others", "_kept")
    )


def _position():
    return F.struct("block", "id")


def file_marks(lines: DataFrame) -> DataFrame:
    """``file, latch``: position of the first ``###`` line, NULL in files without one.

    One value per file and task is shuffled, so a huge file costs no more than a small one.
    """
    mark = F.when(F.col("value").startswith("###"), _position())
    return lines.groupBy("file").agg(F.min(mark).alias("latch"))


def split_by_type(
    lines: DataFrame, type_name: str = "polypeptide", marks: DataFrame | None = None
) -> DataFrame:
    """Lines with ``is_split``: features of the given type before the file's first ``###``.

    ``lines`` is read more than once and must give the same positions each time; lines of files
    are to be staged first. ``marks`` is ``file_marks(lines)``. It is best staged as well: the
    planner then knows whether it is small, and need not shuffle the lines to find out.
    """
    is_type = F.coalesce(gff3.field(F.col("value"), gff3.TYPE), F.lit("")) == type_name
    before = F.col("latch").isNull() | (_position() < F.col("latch"))
    is_split = before & ~F.col("value").startswith("##") & is_type
    return (
        lines.join(file_marks(lines) if marks is None else marks, "file", "left")
        .withColumn("is_split", is_split)
        .drop("latch")
    )


def output_lines(split: DataFrame, files: DataFrame) -> DataFrame:
    """All lines with the ``output`` they go to: those kept, those split off, and the version lines of the latter."""
    name = F.when(F.col("is_split"), split_file_name(F.col("file"), SPLIT_SUFFIX)).otherwise(
        split_file_name(F.col("file"), KEPT_SUFFIX)
    )
    own = split.select(name.alias("output"), "block", "id", "value")
    headers = version_lines(files).withColumn("output", split_file_name(F.col("file"), SPLIT_SUFFIX))
    return own.unionByName(headers.drop("file"))


def kept_lines(split: DataFrame) -> DataFrame:
    return split.where(~F.col("is_split")).drop("is_split")


def split_lines(split: DataFrame, files: DataFrame) -> DataFrame:
    """The split-off lines, led in every file by a version line placed before all positions.

    ``files`` has one row per file, as the marks do, so that a file without any split line gets
    its version line too.
    """
    body = split.where("is_split").select("file", "block", "id", "value")
    return version_lines(files).unionByName(body)


def version_lines(files: DataFrame) -> DataFrame:
    return files.select(
        "file",
        F.lit(-1).cast("long").alias("block"),
        F.lit(-1).cast("long").alias("id"),
        F.lit(HEADER_LINE).alias("value"),
    )
