"""Line-oriented text: GFF3 files with their line order, and lists of table names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annexport.functions import gff3
from annexport.functions.text import clean_name, decoded_path

# Columns that order the lines of a file. A block is one split of the file; ids grow
# along a split, because a task reads a split from its start to its end.
POSITION = ("file", "block", "id")


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``file, block, id, value``: every line, the last one also when it is not terminated.

    Only LF ends a line, so that a CR stays part of it.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.option("lineSep", "\n").text(paths).select(
        decoded_path(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    )


def numbered(lines: DataFrame, within: Sequence[str] = ("file",)) -> DataFrame:
    """``lines`` with their ``line_number`` (from 1) among those of equal ``within`` columns, which are
    in the order of ``POSITION``.

    A line is counted within its split, so that a huge file is counted by many tasks; only one
    count per split meets in one place. ``lines`` is read twice and must give equal positions.
    """
    split = [*dict.fromkeys([*within, "file", "block"])]
    counts = lines.groupBy(*split).agg(F.count(F.lit(1)).alias("_lines"))
    earlier = Window.partitionBy(*within).orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*split, F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(*split).orderBy("id"))
    return (
        lines.withColumn("_place", place).join(offsets, split)
        .withColumn("line_number", F.col("_before") + F.col("_place")).drop("_before", "_place")
    )


def gff3_fields(lines: DataFrame) -> DataFrame:
    """Adds the nine fields; those a line does not have are NULL."""
    parts = F.col("_parts")
    return (
        lines.withColumn("_parts", gff3.fields(F.col("value")))
        .withColumns({name: F.get(parts, F.lit(i)) for i, name in enumerate(gff3.FIELDS)})
        .drop("_parts")
    )


def read_gff3(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return gff3_fields(read_lines(spark, paths))


def clean_names(names: DataFrame, column: str = "value") -> DataFrame:
    """Table names reduced to their safe characters; lines with none left are dropped."""
    cleaned = names.withColumn(column, clean_name(F.col(column)))
    return cleaned.where(F.col(column) != "")


def read_name_list(spark: SparkSession, path: str) -> DataFrame:
    return clean_names(spark.read.text(path)).select(F.col("value").alias("table_name"))
