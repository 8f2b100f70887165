"""Catalog rows (tables, columns, views) of a database or of a set of DataFrames.

Both kinds give the same columns, so the operators on the catalog do not care which it is:
``tables``: owner, table_name, tablespace_name, temporary, num_rows
``columns``: owner, table_name, column_name, data_type
``views``: owner, mview_name
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annexport.sources.rows import known_rows
from annexport.sources.tables import JdbcTables

LONG_TEXT = "CLOB"


@dataclass(frozen=True)
class Catalog:
    tables: DataFrame
    columns: DataFrame
    views: DataFrame

    def merged(self, other: Catalog) -> Catalog:
        """One catalog of both, as of a database with several owners."""
        return Catalog(
            self.tables.unionByName(other.tables),
            self.columns.unionByName(other.columns),
            self.views.unionByName(other.views),
        )


def jdbc_catalog(source: JdbcTables) -> Catalog:
    """The three catalog views. Filters on owner and type are pushed into the database."""

    def view(name: str, *columns: str) -> DataFrame:
        options = {**source.read_options(name), "dbtable": name}
        frame = source.spark.read.format("jdbc").options(**options).load()
        return frame.select(*[F.col(c.upper()).alias(c) for c in columns])

    return Catalog(
        view("all_tables", "owner", "table_name", "tablespace_name", "temporary", "num_rows"),
        view("all_tab_columns", "owner", "table_name", "column_name", "data_type"),
        view("all_mviews", "owner", "mview_name"),
    )


def frames_catalog(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    owner: str,
    views: Iterable[str] = (),
    temporary: Iterable[str] = (),
    tablespaces: Mapping[str, str] | None = None,
    row_counts: Mapping[str, int] | None = None,
) -> Catalog:
    """Catalog of DataFrames: string columns count as long text, row counts are computed where ``row_counts`` has none.

    A table without an entry in ``tablespaces`` is in the space named like its owner. The row lists built here are names taken from the schemas, one per table or column.
    """
    temporary, tablespaces, row_counts = set(temporary), tablespaces or {}, row_counts or {}
    names = [
        (owner, name, tablespaces.get(name, owner), "Y" if name in temporary else "N") for name in sorted(frames)
    ]
    known = [(row_counts[name], name) for name in sorted(frames) if name in row_counts]
    counts = [known_rows(spark, known, "num_rows long, table_name string")] + [
        df.agg(F.count(F.lit(1)).alias("num_rows")).withColumn("table_name", F.lit(name))
        for name, df in sorted(frames.items()) if name not in row_counts
    ]
    tables = known_rows(
        spark, names, "owner string, table_name string, tablespace_name string, temporary string"
    ).join(reduce(DataFrame.unionByName, counts), "table_name", "left")
    # A count taken from file footers is NULL where there is no row.
    tables = tables.withColumn("num_rows", F.coalesce("num_rows", F.lit(0)))
    columns = [
        (owner, name, f.name, LONG_TEXT if isinstance(f.dataType, T.StringType)
         else f.dataType.simpleString().upper())
        for name, df in sorted(frames.items())
        for f in df.schema.fields
    ]
    return Catalog(
        tables,
        known_rows(
            spark, columns, "owner string, table_name string, column_name string, data_type string"
        ),
        known_rows(
            spark, [(owner, v) for v in sorted(set(views))], "owner string, mview_name string"
        ),
    )


def spark_catalog(
    spark: SparkSession, database: str | None = None, views: Iterable[str] = (), session_views: bool = True
) -> Catalog:
    """Catalog of the tables that Spark's own catalog lists in ``database`` (the current one by default); it
    lists the session's own temporary views with those of any database.

    Row counts are those of the tables' statistics (``ANALYZE TABLE``) where they were gathered, and are
    counted elsewhere. Views that are stored count as views, as do those named in ``views``;
    temporary ones count as temporary tables. Only names and types reach the driver.
    """
    database = database or spark.catalog.currentDatabase()
    listed = [t for t in spark.catalog.listTables(database) if session_views or t.namespace]
    quoted = lambda *parts: ".".join("`" + p.replace("`", "``") + "`" for p in parts)
    full = {t.name: quoted(*(t.namespace or ()), t.name) for t in listed}
    return frames_catalog(
        spark, {name: spark.table(path) for name, path in full.items()}, database,
        views={*views, *(t.name for t in listed if t.tableType == "VIEW" and not t.isTemporary)},
        temporary=[t.name for t in listed if t.isTemporary],
        row_counts={
            t.name: rows for t in listed if not t.isTemporary and t.tableType != "VIEW"
            if (rows := _gathered_rows(spark, full[t.name])) is not None
        },
    )


def _gathered_rows(spark: SparkSession, table: str) -> int | None:
    """The row count of a table's statistics, if there is one."""
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Statistics'").collect():
        found = re.search(r"(\d+) rows", row.data_type)
        return int(found[1]) if found else None
    return None
