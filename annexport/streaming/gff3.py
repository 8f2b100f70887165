"""GFF3 files as they arrive in a folder: clean-up of database references, split by type.

The clean-up is row by row and runs as a plain stream. The split needs to know where a file's first
``###`` is; a file arrives whole in one micro-batch, so it runs as the batch split on each of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from annexport.functions.text import decoded_path
from annexport.operators.gff3 import clean_dbxref
from annexport.plans.chado import split_placed


def line_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """``value`` of every line, with the ``file`` and ``block`` it was read from."""
    reader = spark.readStream.option("lineSep", "\n")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder).select(
        "value", decoded_path(F.col("_metadata.file_path")).alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def clean_dbxref_stream(
    spark: SparkSession, folder: str, path: str, checkpoint: str, names: Sequence[str],
    files_per_batch: int | None = None, until_caught_up: bool = True,
) -> StreamingQuery:
    """Starts the clean-up. The checkpoint keeps which files are done, so a restart repeats none."""
    cleaned = clean_dbxref(line_stream(spark, folder, files_per_batch).select("value"), names)
    writer = (
        cleaned.writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if until_caught_up:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def split_polypeptide_stream(
    spark: SparkSession, folder: str, path: str, checkpoint: str,
    files_per_batch: int | None = None, until_caught_up: bool = True,
) -> StreamingQuery:
    """Starts the split: ``batch=<number>/output=<name>/start=<start of a split>`` folders below ``path``.

    A batch's folder is named by its number and replaced as a whole, so a batch that is run again after
    a failure leaves its lines once.
    """

    def split(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            split_placed(batch.withColumn("id", F.monotonically_increasing_id()), f"{path}/batch={number:020d}")

    writer = line_stream(spark, folder, files_per_batch).writeStream.foreachBatch(split).option("checkpointLocation", checkpoint)
    if until_caught_up:
        writer = writer.trigger(availableNow=True)
    return writer.start()
