"""Table sources. Operators take DataFrames; a source only says where a named table is."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annexport.session import staged


OLD_SOURCES = "spark.sql.sources.useV1SourceList"


@dataclass(frozen=True)
class FileTables:
    """Tables kept as one folder or file each under ``root``."""

    spark: SparkSession
    root: str
    format: str = "parquet"
    suffix: str = ".parquet"
    empty_is_null: bool = False  # whether an empty text counts as none

    def table(self, name: str) -> DataFrame:
        return self.spark.read.format(self.format).load(f"{self.root}/{name}{self.suffix}")

    def frames(self, names: Iterable[str]) -> dict[str, DataFrame]:
        """Several tables at once; listing files and reading schemas overlaps."""
        names = list(names)
        with ThreadPoolExecutor(max_workers=8) as pool:
            return dict(zip(names, pool.map(self.table, names)))


    def footer_frames(self, names: Iterable[str]) -> dict[str, DataFrame]:
        """The same, whose plain counts of rows and non-NULL values Spark takes from the footers of Parquet files.

        Spark pushes aggregates into its newer file sources only; which one a table is read by is settled when it is
        opened, so the setting that says so is put back at once.
        """
        names, listed = list(names), self.spark.conf.get(OLD_SOURCES)
        self.spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        self.spark.conf.set(OLD_SOURCES, ",".join(x for x in listed.split(",") if x.strip() != self.format))
        try:
            return self.frames(names)
        finally:
            self.spark.conf.set(OLD_SOURCES, listed)


@dataclass(frozen=True)
class JdbcTables:
    """Tables of a database reached through JDBC.

    A table with an entry in ``id_columns`` is read in id ranges, so that no single task reads all
    of it. The database itself numbers the ids in their order and hands out every ``rows_per_task``-th of them;
    ranges between these hold that many rows each, however the ids are spread. (Rows that share
    one id stay together.) With ``balanced=False``, for databases without window functions, ranges are equally wide: ``partitions``
    of them, or as many as would leave ``rows_per_task`` to each if ids were dense. A table without an entry is refused unless ``one_task`` names it, because a
    single task would read it. In the databases meant here an empty text is NULL. Long text makes rows
    wide, so the fetch size is small by default. ``schemas`` gives column types per table where
    the driver's own are unfit, as with numbers declared without precision. Credentials are
    passed in ``options`` and are never stored here.
    """

    spark: SparkSession
    url: str
    owner: str | None = None
    partitions: int = 64
    rows_per_task: int = 200_000
    balanced: bool = True
    one_task: tuple[str, ...] = ()
    empty_is_null: bool = True
    fetch_size: int = 200
    id_columns: dict[str, str] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)
    options: dict[str, str] = field(default_factory=dict, repr=False)

    def qualified(self, name: str) -> str:
        return f"{self.owner}.{name}" if self.owner and "." not in name else name

    def read_options(
        self, name: str, bounds: tuple[int, int] | None = None, partitions: int | None = None
    ) -> dict[str, str]:
        options = {
            "url": self.url,
            "dbtable": self.qualified(name),
            "fetchsize": str(self.fetch_size),
            **self.options,
        }
        if name in self.schemas:
            options["customSchema"] = self.schemas[name]
        id_column = self.id_columns.get(name)
        if id_column and bounds:
            options |= {
                "partitionColumn": id_column,
                "lowerBound": str(bounds[0]),
                "upperBound": str(bounds[1] + 1),
                "numPartitions": str(partitions or self.partitions),
            }
        return options

    def bounds_options(self, name: str) -> dict[str, str]:
        id_column = self.id_columns[name]
        query = f"(SELECT MIN({id_column}) lo, MAX({id_column}) hi, COUNT(*) n FROM {self.qualified(name)}) q"
        return {"url": self.url, **self.options, "dbtable": query}

    def quantiles_query(self, name: str) -> str:
        """Every ``rows_per_task``-th id of a table, in plain SQL."""
        return quantiles_sql(self.qualified(name), self.id_columns[name], self.rows_per_task)

    def range_count(self, rows: int) -> int:
        return max(self.partitions, -(-rows // self.rows_per_task))

    def table(self, name: str) -> DataFrame:
        bounds = ranges = None
        if name in self.id_columns and self.balanced:
            options = {"url": self.url, **self.options, "dbtable": f"({self.quantiles_query(name)}) q"}
            ids = [r[0] for r in self.spark.read.format("jdbc").options(**options).load().collect()]
            properties = {k: v for k, v in self.read_options(name).items() if k not in ("url", "dbtable")}
            return self.spark.read.jdbc(
                self.url, self.qualified(name), predicates=range_predicates(self.id_columns[name], ids), properties=properties
            )
        if name in self.id_columns:
            row = self.spark.read.format("jdbc").options(**self.bounds_options(name)).load().first()
            if row is not None and row[0] is not None:
                bounds, ranges = (int(row[0]), int(row[1])), self.range_count(int(row[2]))
        elif name not in self.one_task:
            raise ValueError(f"{name} has no id column to read it by; name it in id_columns or one_task")
        return self.spark.read.format("jdbc").options(**self.read_options(name, bounds, ranges)).load()


@dataclass(frozen=True)
class StagedTables:
    """Tables of another source, each read from it once and then from the shared folder.

    Meant for databases: checks and exports that use a table several times then see one state of
    it and ask the database for it once. ``columns`` says what is read of each table; a table without
    an entry is refused, so that no long text is copied that nobody reads.
    """

    source: FileTables | JdbcTables

    @property
    def empty_is_null(self) -> bool:
        return self.source.empty_is_null

    columns: dict[str, tuple[str, ...]] = field(default_factory=dict)
    _read: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            if name not in self.columns:
                raise ValueError(f"{name} has no entry in columns")
            self._read[name] = staged(self.source.table(name).select(*self.columns[name]), name)
        return self._read[name]


def quantiles_sql(table: str, id_column: str, rows_per_range: int) -> str:
    """Every ``rows_per_range``-th id of a table in the order of ids, as a query any database with window functions runs."""
    return (
        f"SELECT {id_column} FROM (SELECT {id_column}, ROW_NUMBER() OVER (ORDER BY {id_column}) place "
        f"FROM {table} WHERE {id_column} IS NOT NULL) numbered WHERE MOD(place, {rows_per_range}) = 0"
    )


def range_predicates(id_column: str, bounds: Iterable) -> list[str]:
    """Conditions that part a table's rows by id: up to each bound, and above the last. NULL ids go with the first.

    A bound that many rows share, or that is the greatest id, makes no empty or double range.
    """
    bounds = [str(int(b)) for b in sorted(set(bounds))]
    if not bounds:
        return ["1 = 1"]
    lows, highs = [None, *bounds], [*bounds, None]
    found = []
    for low, high in zip(lows, highs):
        parts = ([f"{id_column} > {low}"] if low else []) + ([f"{id_column} <= {high}"] if high else [])
        found.append(" AND ".join(parts) if low else f"({parts[0]} OR {id_column} IS NULL)")
    return found


def quantile_bounds(df: DataFrame, id_column: str, rows_per_range: int) -> list[int]:
    """What ``quantiles_sql`` finds, for a DataFrame: every ``rows_per_range``-th id, each once.

    Ids alone are sorted, by ranges over all tasks; a count per range gives each id its place. A bound per range
    of the result reaches the driver.
    """
    ids = df.select(F.col(id_column).cast("long").alias("id")).where("id is not null").orderBy("id")
    ids = staged(ids.select("id", F.monotonically_increasing_id().alias("at")), "ids")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(2**33 - 1)
    counts = ids.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(
        F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    places = ids.withColumn("part", part).join(counts.select("part", before.alias("before")), "part")
    bounds = places.where((F.col("before") + place + 1) % rows_per_range == 0).select("id").distinct()
    return sorted(r.id for r in bounds.collect())


def balanced_ranges(df: DataFrame, id_column: str, rows_per_range: int) -> DataFrame:
    """Rows of each range a balanced read of ``df`` uses: ``id_range, row_count, lowest_id, highest_id``.

    Each range is read by its own condition, as a database would be.
    """
    predicates = range_predicates(id_column, quantile_bounds(df, id_column, rows_per_range))
    return reduce(DataFrame.unionByName, [
        df.where(p).agg(
            F.lit(k).alias("id_range"), F.count(F.lit(1)).alias("row_count"),
            F.min(id_column).alias("lowest_id"), F.max(id_column).alias("highest_id"),
        ) for k, p in enumerate(predicates)
    ]).where("row_count > 0")


def id_ranges(df: DataFrame, id_column: str, partitions: int) -> DataFrame:
    """Rows of each id range a partitioned read of ``df`` would use.

    The two bounds are one aggregate row; the counts combine on the map side, so a range that
    holds most rows is still counted in parallel.
    """
    low, high = df.agg(F.min(id_column), F.max(id_column)).first()
    if low is None:
        low = high = 0
    width = max(1, -(-(high - low + 1) // partitions))
    index = F.call_function("div", F.col(id_column) - F.lit(low), F.lit(width)).cast("int")
    return (
        df.groupBy(F.coalesce(index, F.lit(0)).alias("id_range"))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min(id_column).alias("lowest_id"),
            F.max(id_column).alias("highest_id"),
        )
    )
