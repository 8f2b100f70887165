"""Session settings the jobs are meant to run with, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Fixed values. AQE sizes reduce partitions, turns joins into broadcasts only after measuring
# the small side, and splits skewed join partitions even where that costs a further shuffle.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Aimed size of a task's input and of a reduce partition. Long text rows are wide, so
# partitions are sized by bytes, never by rows.
PARTITION_BYTES = 128 * 1024 * 1024


def sized_settings(shuffle_bytes: int, cores: int, partition_bytes: int = PARTITION_BYTES) -> dict[str, str]:
    """``SETTINGS`` plus partition sizes for the largest shuffle a job will make.

    Reduce partitions start out many enough to fit the executors' memory and are merged by AQE
    where they turn out small.
    """
    return {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(max(cores, -(-shuffle_bytes // partition_bytes))),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
    }


CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints, which every executor can reach.

    Only a local session may do without the setting; its folder is then one below the warehouse.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_DIR} must name a shared folder")
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name of this application below the shared folder."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/{application}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read from there.

    Its rows are then fixed, survive the loss of executors, and have a size the planner knows:
    it broadcasts a small staged table in a join and shuffles a large one.
    """
    return _staged_at(df, scratch_path(df.sparkSession, name))


def _staged_at(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a folder of ``scratch_path``, wherever Spark keeps it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def unchecked_path(path: str) -> str:
    """A new folder name beside ``path``, in the same file system; readers skip names that begin so."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_unchecked-{name}-{uuid.uuid4().hex}" if parent else f"_unchecked-{name}-{uuid.uuid4().hex}"


def moved(spark: SparkSession, path: str, to: str) -> None:
    """Renames a folder, which takes the place of what is at ``to``."""
    jvm = spark._jvm.org.apache.hadoop.fs
    folder, target = jvm.Path(path), jvm.Path(to)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(target, True)
    if not system.rename(folder, target):
        raise OSError(f"{path} could not be renamed to {to}")


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """``staged`` for one export: what it staged is deleted when the export ends."""
    paths: list[str] = []

    def stage(df: DataFrame, name: str) -> DataFrame:
        paths.append(scratch_path(spark, name))
        return _staged_at(df, paths[-1])

    try:
        yield stage
    finally:
        for path in paths:
            discard(spark, path)


def tuned(spark: SparkSession) -> SparkSession:
    """The session with the one setting of ``SETTINGS`` that Spark leaves off and that changes no result."""
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark
