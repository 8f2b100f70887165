"""Small frames made of rows known to the driver, such as table names."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def known_rows(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """Built from Arrow, so that the plan holds the rows as a local relation of known size."""
    fields = StructType.fromDDL(schema)
    columns = list(zip(*rows)) or [()] * len(fields)
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, to_arrow_schema(fields))]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=fields.names), fields)
