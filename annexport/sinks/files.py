"""File sinks. Each writes a folder of part files; nothing passes through the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annexport.sources.text import POSITION

# Options that make the CSV text read back as it was (doubled quotes, empty
# text without quotes, no trimming, LF as the only record end).
CSV_WRITE = {
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "lineSep": "\n",
}
CSV_READ = {**CSV_WRITE, "multiLine": "true"}


def write_csv(
    df: DataFrame, path: str, header: bool = True, partition_by: Sequence[str] = (), rebalanced: bool = False
) -> None:
    """``rebalanced`` brings the rows of a folder together before they are written, so that a small folder
    is one file however many tasks had rows of it, and cuts the rows of a large one by size."""
    if rebalanced:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").options(**CSV_WRITE).option("header", header)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_lines(df: DataFrame, path: str, line: Column | str, partition_by: Sequence[str] = ()) -> None:
    """One string per row, as it is."""
    line = F.col(line) if isinstance(line, str) else line
    writer = df.select(line.alias("value"), *partition_by).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("lineSep", "\n").text(path)


def write_ordered_lines(
    df: DataFrame,
    path: str,
    order: Sequence[str],
    line: str = "value",
    partition_by: Sequence[str] = (),
) -> None:
    """Lines in the given order: part files in name order, rows in file order.

    The sort is by ranges of the full position, so one huge file is spread over many tasks.
    The folder columns lead the sort, so the writer needs no further one.
    """
    ordered = df.orderBy(*partition_by, *order)
    write_lines(ordered, path, line, partition_by)


def placed_lines(df: DataFrame) -> DataFrame:
    """Lines with the folders they go to, in order within each task."""
    name = F.substring_index("file", "/", -1)
    hashed = F.lpad(F.lower(F.hex(F.xxhash64("file"))), 16, "0")
    placed = df.withColumns({
        "input": F.concat(name, F.lit("-"), hashed), "start": split_start(),
    })
    return placed.sortWithinPartitions("input", "start", *POSITION[1:])


def split_start(block: str = "block") -> Column:
    """Folder name of a split's start; names sort as the starts do, also a start before all others (-1)."""
    return F.format_string("%020d", block)


def write_output_lines(df: DataFrame, path: str) -> None:
    """Lines with their ``output`` in the order they were read, without a shuffle: one folder per output and
    start of a split, ``output=<name>/start=<20 digits>``.

    As in ``write_placed_lines`` a split is read by one task, so each folder has one part file.
    """
    placed = df.withColumn("start", split_start()).sortWithinPartitions("output", "start", *POSITION[1:])
    write_lines(placed, path, "value", ["output", "start"])


def write_placed_lines(df: DataFrame, path: str) -> None:
    """Lines in the order they were read, without a shuffle: one folder per file and start of a
    split, ``input=<name>-<hash of its path>/start=<20 digits>``.

    Each split is read by one task, which writes its lines in order; the folder names put the
    splits of a file in order. The hash keeps files of one name apart.
    """
    write_lines(placed_lines(df), path, "value", ["input", "start"])


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines; NULL fields are kept."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
