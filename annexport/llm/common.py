"""What several operators share: words, id remainders, column names, blocks of a stated query set."""

from __future__ import annotations

import ctypes
import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annexport.sources.tables import FileTables

# A word: a run of anything but ASCII white space. bytes.split() cuts at the same six bytes.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return FileTables(spark, sf_dir).table(name)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def id_remainder(identifier: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(identifier.cast("string"), F.lit("")).cast("binary")) % divisor


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # None where the C library has no such call


def give_back() -> None:
    """Freed memory goes back to the system: workers are kept, beside an executor that needs it too."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


BATCH_BYTES = 4 << 20


def in_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session hands rows to Python in Arrow batches of ``BATCH_BYTES`` at most (or one row).

    Texts are wide: by number of rows alone, or at Spark's 64 MB, several copies of a batch on either side
    take a good part of an executor's memory.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


_CACHE: dict[str, object] = {}


def worker_cache(owner: str, make: Callable[[], object]):
    """What ``make`` made for ``owner`` in this Python worker, kept from task to task. Workers outlive
    stages, so there is one owner at a time: another one's cache is dropped."""
    if owner not in _CACHE:
        _CACHE.clear()
        give_back()
        _CACHE[owner] = make()
    return _CACHE[owner]


def utf8(texts: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text; NULL is empty."""
    for cell in texts.cast(pa.large_binary()):
        yield cell.as_py() or b""


def blocks(rows: Iterator, size, limit: int) -> Iterator[list]:
    """Consecutive runs of rows whose sizes sum to ``limit`` at most (or single larger rows)."""
    block, total = [], 0
    for row in rows:
        n = size(row)
        if block and total + n > limit:
            yield block
            block, total = [], 0
        block.append(row)
        total += n
    if block:
        yield block
