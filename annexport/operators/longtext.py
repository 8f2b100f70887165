"""Long text columns: which tables have them, and their export."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annexport.functions.text import export_file_name, normalise_lines
from annexport.operators.membership import not_exists, not_in
from annexport.sources.catalog import LONG_TEXT, Catalog
from annexport.sources.rows import known_rows

# Tables whose id column is not <TABLE>_ID.
ID_COLUMNS = {"paragraph": "PARAGRAPH_NO", "plasmid": "ID"}

# Tables never exported.
EXCLUDED_TABLES = ("CHADO_LOGS", "CHADOPROP")

# Registered tables and their long text columns.
REGISTERED_TABLES = {
    "analysis": ("DESCRIPTION", "SOURCEURI"),
    "arraydesign": ("ARRAY_DIMENSIONS", "DESCRIPTION", "ELEMENT_DIMENSIONS", "VERSION"),
    "chadologs": ("NEW_VALUE", "OLD_VALUE"),
    "chadoprop": ("VALUE",),
    "cv": ("DEFINITION",),
    "cvprop": ("VALUE",),
    "cvterm": ("DEFINITION",),
    "dbxref": ("DESCRIPTION",),
    "feature": ("RESIDUES",),
    "feature_cvtermprop": ("VALUE",),
    "feature_pubprop": ("VALUE",),
    "feature_relationship": ("VALUE",),
    "featureloc": ("RESIDUE_INFO",),
    "featureprop": ("VALUE",),
    "organism": ("COMMENT_",),
    "organismprop": ("VALUE",),
    "paragraph": ("PARAGRAPH_TEXT",),
    "phenotype": ("VALUE",),
    "plasmid": ("SEQUENCE",),
    "pub": ("TITLE", "VOLUMETITLE"),
    "pubprop": ("VALUE",),
}

TEXT_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType)


@dataclass(frozen=True)
class TextTable:
    """What to export of one table; ``rename`` gives header names other than the columns'."""

    name: str
    columns: tuple[str, ...]
    id_column: str
    rename: Mapping[str, str] = field(default_factory=dict)


def id_column(table: str) -> str:
    return ID_COLUMNS.get(table.lower(), f"{table}_ID")


def registered_table(name: str) -> TextTable:
    columns = REGISTERED_TABLES.get(name.lower())
    if columns is None:
        raise KeyError(f"no registered columns for table {name}")
    # This table's key carries an underscore that its registered name does not.
    key = "CHADO_LOGS_ID" if name.lower() == "chadologs" else id_column(name.upper())
    return TextTable(name.lower(), columns, key)


def registry_frame(spark: SparkSession, names: Iterable[str] = REGISTERED_TABLES) -> DataFrame:
    return known_rows(spark, [(n,) for n in sorted(names)], "table_name string")


def populated_text_columns(
    catalog: Catalog, owner: str, exclude: Sequence[str] = EXCLUDED_TABLES
) -> DataFrame:
    """``table_name, column_name`` of long text columns of the owner's non-empty tables.

    Views are left out. A table without a row count does not count as filled.
    """
    filled = catalog.tables.where(F.col("num_rows") > 0).select("owner", "table_name")
    columns = catalog.columns.where(
        (F.col("owner") == owner)
        & (F.col("data_type") == LONG_TEXT)
        & ~F.col("table_name").isin(*exclude)
    )
    views = catalog.views.select("owner", F.col("mview_name").alias("table_name"))
    return (
        not_exists(columns.join(filled, ["owner", "table_name"]), views, ["owner", "table_name"])
        .select("table_name", "column_name")
    )


def text_export_specs(columns: DataFrame) -> DataFrame:
    """``table_name, columns, id_column, output_file``: one row per table to export."""
    override = F.create_map(*[F.lit(v) for pair in ID_COLUMNS.items() for v in pair])
    return columns.groupBy("table_name").agg(
        F.sort_array(F.collect_list("column_name")).alias("columns")
    ).select(
        "table_name",
        "columns",
        F.coalesce(
            F.try_element_at(override, F.lower("table_name")),
            F.concat("table_name", F.lit("_ID")),
        ).alias("id_column"),
        export_file_name(F.col("table_name")).alias("output_file"),
    )


def column_statistics(frames: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, column_name, non_null, max_length`` of every string column.

    Each table is read once for all its text columns and reduced to one row by its tasks; the
    row is then turned into one row per column.
    """
    parts = []
    for name, df in sorted(frames.items()):
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        if not columns:
            continue
        row = df.agg(*[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("non_null"),
                F.coalesce(F.max(F.length(c)), F.lit(0)).cast("long").alias("max_length"),
            ).alias(c)
            for c in columns
        ])
        stats = row.select(F.inline(F.array(*columns)))
        parts.append(stats.withColumn("table_name", F.lit(name)))
    return reduce(DataFrame.unionByName, parts).select(
        "table_name", "column_name", "non_null", "max_length"
    )


def filled_text_columns(
    frames: Mapping[str, DataFrame], views: DataFrame | None = None, exclude: Sequence[str] = EXCLUDED_TABLES
) -> DataFrame:
    """``table_name, column_name`` of the text columns that hold any value, whatever a catalog says of their tables.

    Plain counts, one aggregation a table: from ``FileTables.footer_frames`` they are read off file
    footers, and no row is. ``views`` (mview_name) and ``exclude`` name the tables to leave out.
    """
    parts = []
    for name, df in sorted(frames.items()):
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        if columns and name not in set(exclude):
            row = df.agg(*[F.count(c).alias(c) for c in columns])
            pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("non_null")) for c in columns])
            parts.append(row.select(F.lit(name).alias("table_name"), F.inline(pairs)))
    found = reduce(DataFrame.unionByName, parts).where(F.col("non_null") > 0)
    if views is not None:
        found = not_exists(found, views.select(F.col("mview_name").alias("table_name")), ["table_name"])
    return found.select("table_name", "column_name")


def text_column_inventory(
    frames: Mapping[str, DataFrame], views: DataFrame, exclude: Sequence[str] = EXCLUDED_TABLES
) -> DataFrame:
    """Statistics of the filled text columns, with the file each table's export goes to.

    ``views`` (mview_name) and ``exclude`` name the tables to leave out. Row counts are taken
    from the data here, so that stale database statistics cannot hide a table.
    """
    kept = {n: df for n, df in frames.items() if n not in set(exclude)}
    stats = column_statistics(kept).where(F.col("non_null") > 0)
    names = views.select(F.col("mview_name").alias("table_name"))
    return not_exists(stats, names, ["table_name"]).withColumn(
        "output_file", export_file_name(F.col("table_name"))
    )


def table_names(catalog: Catalog, owner: str) -> DataFrame:
    """The owner's permanent tables that are not views."""
    tables = catalog.tables.where((F.col("owner") == owner) & (F.col("temporary") == "N"))
    views = catalog.views.where(F.col("owner") == owner).select(
        F.col("mview_name").alias("table_name")
    )
    return not_in(tables, views, "table_name").select("table_name", "num_rows")


def own_space_table_names(catalog: Catalog, owner: str) -> DataFrame:
    """The owner's tables kept in the space of the same name."""
    own = (F.col("owner") == owner) & (F.col("tablespace_name") == owner)
    return catalog.tables.where(own).select("table_name", "num_rows")


def has_text(columns: Sequence[str], empty_is_null: bool = False) -> Column:
    """True where any of the columns holds text."""
    values = [F.nullif(F.col(c), F.lit("")) if empty_is_null else F.col(c) for c in columns]
    return F.coalesce(*values).isNotNull()


def text_columns_export(df: DataFrame, spec: TextTable, empty_is_null: bool = False) -> DataFrame:
    """Id and text columns of the rows that have any text.

    ``empty_is_null`` follows databases in which an empty text is NULL.
    """
    return df.where(has_text(spec.columns, empty_is_null)).select(spec.id_column, *spec.columns)


def _has_text_form(data_type: T.DataType) -> bool:
    whole_decimal = isinstance(data_type, T.DecimalType) and data_type.scale == 0
    return whole_decimal or isinstance(data_type, TEXT_TYPES)


def whole_id(df: DataFrame, column: str) -> DataFrame:
    """The id as a whole number; databases may hand out ids as decimals with a fraction."""
    is_decimal = isinstance(df.schema[column].dataType, T.DecimalType)
    return df.withColumn(column, F.col(column).cast("decimal(38,0)")) if is_decimal else df


def as_text(df: DataFrame, rename: Mapping[str, str] | None = None) -> DataFrame:
    """All columns as text, NULL as the empty string, under their header names.

    Only whole numbers and strings have a text form here; other types are an error, raised
    before anything runs.
    """
    bad = [f.name for f in df.schema.fields if not _has_text_form(f.dataType)]
    if bad:
        raise TypeError(f"unsupported column type: {', '.join(bad)}")
    rename = rename or {}
    return df.select(*[
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(rename.get(c, c)) for c in df.columns
    ])


def long_text_export(
    df: DataFrame, id_name: str, text: str, types: DataFrame | None = None,
    type_on: str = "type_id", type_name: str = "feature_type",
) -> DataFrame:
    """Id, type name when ``types`` is given, and text with its line ends made LF.

    ``types`` is (``type_on``, ``type_name``); rows without a type or text are left out.
    """
    rows = df.where(F.col(text).isNotNull())
    columns = [F.col(id_name)]
    if types is not None:
        rows = rows.join(types.select(type_on, type_name), type_on)
        columns.append(F.col(type_name))
    return rows.select(*columns, normalise_lines(F.col(text)).alias(text))


def table_json(df: DataFrame) -> DataFrame:
    """Each row as one JSON object; NULL fields are kept."""
    return df.select(
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json")
    )
