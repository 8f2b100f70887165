"""The registered queries: every operator bound to the test tables.

Roles: order = ``orders``; contact = ``customer``; ordered item = ``lineitem``; plasmid catalog =
parts of size 25 and less; stock = ``supplier``; long text = ``documents``, ``pages``,
``conversations``, ``benchmark``; curator flags = ``labels``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annexport.functions.text import prefixed_id, split_file_name, timestamp_text
from annexport.operators import gff3 as gff3_lines
from annexport.operators import longtext, membership, orders, slices
from annexport.operators.checks import required_violations, unregistered
from annexport.operators.descriptions import described_entities
from annexport.operators.phenotype import strain_phenotype
from annexport.operators.provenance import accession_provenance, entity_provenance
from annexport.plans import chado
from annexport.plans.exports import Export, export_tables
from annexport.session import scratch_path, staged, tuned
from annexport.sinks.files import CSV_READ, write_csv, write_json, write_lines, write_ordered_lines
from annexport.sources.catalog import Catalog, frames_catalog, spark_catalog
from annexport.sources.rows import known_rows
from annexport.sources.tables import FileTables, balanced_ranges, id_ranges
from annexport.sources.text import POSITION, clean_names, gff3_fields, numbered, read_lines
from annexport.streaming.gff3 import split_polypeptide_stream

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
OWNER = "lake"
VIEWS = ("benchmark",)
TEMPORARY = ("events",)
TABLESPACES = {"embeddings": "users", "events": "users"}  # all other tables: the owner's own
OTHER_OWNER = "archive"
OTHER_VIEWS = ("documents",)
EXCLUDED = ("region",)
REGISTERED = ("documents", "pages", "conversations", "customer", "orders")
REMOVED_DATABASES = ("GeneID", "NCBI_GP")
CATALOG_SIZE = 25
SCAN_RANGES = 16


def tables(spark: SparkSession, sf_dir: str):
    return FileTables(tuned(spark), sf_dir).table


def _frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return FileTables(spark, sf_dir).frames(TABLES)


def _catalog(spark: SparkSession, sf_dir: str):
    """Its row counts come from file footers."""
    return frames_catalog(spark, FileTables(spark, sf_dir).footer_frames(TABLES), OWNER, VIEWS, TEMPORARY)


def _two_owners(spark: SparkSession, sf_dir: str) -> Catalog:
    """A second owner has tables of the same names: ``benchmark`` is no view there, ``documents`` is
    one, ``pages`` is empty, and ``nation`` is kept in the first owner's space."""
    frames = _frames(spark, sf_dir)
    other = {n: frames[n] for n in ("benchmark", "documents", "nation")}
    other["pages"] = known_rows(spark, [], "url string, html string")
    return frames_catalog(spark, frames, OWNER, VIEWS, TEMPORARY, TABLESPACES).merged(
        frames_catalog(spark, other, OTHER_OWNER, OTHER_VIEWS, tablespaces={"nation": OWNER})
    )


# --- orders ---------------------------------------------------------------------------------


def _contacts(table) -> DataFrame:
    return orders.order_contacts(
        table("orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_date"),
            F.col("o_custkey").alias("c_custkey"),
        ),
        [(table("customer").select("c_custkey", F.col("c_name").alias("contact")), "c_custkey")],
    ).drop("c_custkey")


def _items(table) -> DataFrame:
    return table("lineitem").select(
        F.col("l_orderkey").alias("order_id"), "l_partkey", "l_suppkey", "l_linenumber"
    )


def _parts(table) -> DataFrame:
    return table("part").where(F.col("p_size") <= CATALOG_SIZE)


def _manifest(table, label, form=orders.order_manifest) -> DataFrame:
    return form(
        _contacts(table),
        _items(table).drop("l_linenumber"),
        _parts(table).select(F.col("p_partkey").alias("l_partkey"), label.alias("catalog_label")),
        table("supplier").select(
            F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("stock_label")
        ),
        on="l_partkey", stock_on="l_suppkey",
    )


def order_manifest(spark, sf_dir):
    manifest = _manifest(tables(spark, sf_dir), F.col("p_name"))
    return manifest.withColumn("items", F.array_join("items", "|"))


def order_manifest_csv(spark, sf_dir):
    label = F.concat("p_name", F.lit(',"'), "p_brand")
    manifest = _manifest(tables(spark, sf_dir), label)
    return orders.manifest_csv(manifest).select("order_id", "line")


def order_manifest_file(spark, sf_dir):
    """The same through a folder of text lines, sorted as the export is, and read back."""
    table = tables(spark, sf_dir)
    path = scratch_path(spark, "order_manifest_file")
    lines = orders.manifest_csv(_manifest(table, F.concat("p_name", F.lit(',"'), "p_brand")))
    write_lines(lines.orderBy("order_date", "contact", "order_id"), path, "line")
    return spark.read.option("lineSep", "\n").text(path).withColumnRenamed("value", "line")


def order_manifest_by_id(spark, sf_dir):
    """The manifest as exported: stocks told from catalog items by id, the items read once. Numbers repeat
    within orders here, and that of every ninth part's line is NULL."""
    table = tables(spark, sf_dir)
    number = F.when(F.col("l_partkey") % 9 != 0, F.col("l_linenumber"))
    labels = chado.staged_labels(
        staged, _items(table).withColumn("l_linenumber", number),
        _parts(table).select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("catalog_label")),
        table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("stock_label")),
        "l_partkey", "l_suppkey", "l_linenumber",
    )
    return orders.manifest_of(_contacts(table), labels).withColumn("items", F.array_join("items", "|"))


def order_manifest_items(spark, sf_dir):
    """The long form: a row per order, contact and label."""
    return _manifest(tables(spark, sf_dir), F.col("p_name"), orders.manifest_items)


def order_contacts(spark, sf_dir):
    table = tables(spark, sf_dir)
    return orders.order_contacts(
        table("orders").select("o_orderkey", "o_custkey", "o_orderdate"),
        [
            (table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey"), "o_custkey"),
            (table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey"), "c_nationkey"),
            (table("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name"), "n_regionkey"),
        ],
        sort=["o_orderdate", "c_name", "o_orderkey"],
    ).select(
        F.col("o_orderkey").alias("order_id"),
        timestamp_text(F.col("o_orderdate")).alias("order_date"),
        F.col("c_name").alias("contact"),
        "n_name",
        "r_name",
    )


def _written_lines(spark, path: str) -> DataFrame:
    """Lines of a folder of part files, numbered in the order of part names and lines."""
    return numbered(read_lines(spark, path).withColumn("folder", F.lit(0)), ["folder"]).select("line_number", "value")


def order_contacts_file(spark, sf_dir):
    """Contacts written in order of date and name, read back with their line numbers."""
    path = scratch_path(spark, "order_contacts_file")
    rows = order_contacts(spark, sf_dir)
    write_lines(rows, path, F.concat_ws("|", "order_date", "contact", "order_id"))
    return _written_lines(spark, path)


def order_catalog_items(spark, sf_dir):
    table = tables(spark, sf_dir)
    named = _items(table).join(
        table("part").select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey"
    )
    catalog = _parts(table).select(F.col("p_partkey").alias("l_partkey"))
    return orders.order_catalog_items(named, catalog, "l_partkey", ["order_id", "p_name"])


def _catalog_keys(table) -> DataFrame:
    return _parts(table).select(F.col("p_partkey").alias("l_partkey"))


def _other_items(table, item_id=None, listed=None) -> DataFrame:
    return orders.order_other_items(
        _items(table),
        _catalog_keys(table),
        table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name"),
        "l_partkey", "l_suppkey", ["order_id", "s_name"], item_id, listed,
    )


def order_other_items(spark, sf_dir):
    return _other_items(tables(spark, sf_dir))


def order_other_items_by_id(spark, sf_dir):
    """Line numbers repeat within orders here, so the id rule leaves out more than the flag."""
    table, item_id = tables(spark, sf_dir), "l_linenumber"
    ids = orders.listed_ids(_items(table), _catalog_keys(table), "l_partkey", item_id)
    return _other_items(table, item_id, staged(ids, "listed_ids"))


# --- provenance, phenotypes, descriptions ---------------------------------------------------


def entity_provenance_rows(spark, sf_dir):
    table = tables(spark, sf_dir)
    shipped = table("lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.min("l_shipdate").alias("date_created"), F.max("l_shipdate").alias("date_modified")
    )
    entities = table("supplier").select("s_suppkey", F.col("s_name").alias("created_by")).join(
        shipped, "s_suppkey"
    )
    return entity_provenance(entities, prefixed_id(F.col("s_suppkey"), "SUP", 7))


def accession_provenance_file(spark, sf_dir):
    """Suppliers under the names they point to, through a CSV folder without header."""
    table = tables(spark, sf_dir)
    shipped = table("lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.min("l_shipdate").alias("date_created"), F.max("l_shipdate").alias("date_modified")
    )
    entities = shipped.withColumn("created_by", F.concat(F.lit('a "b", '), F.col("s_suppkey").cast("string")))
    accessions = table("supplier").select("s_suppkey", F.col("s_name").alias("accession"))
    rows = accession_provenance(entities, accessions, "s_suppkey")
    path = scratch_path(spark, "accession_provenance")
    write_csv(rows, path, header=False)
    return spark.read.schema(rows.schema).options(**CSV_READ).csv(path)


def lookup_value_misses(spark, sf_dir):
    """Documents whose label is not there or has no value."""
    table = tables(spark, sf_dir)
    docs = table("documents").select("doc_id")
    values = docs.join(table("labels").select("doc_id", "quality"), "doc_id", "left")
    return membership.lookup_misses(docs, values, "doc_id", ["quality"])


def lookup_misses(spark, sf_dir):
    """Documents without a curator label."""
    table = tables(spark, sf_dir)
    return membership.lookup_misses(
        table("documents").select("doc_id"), table("labels").select("doc_id"), "doc_id"
    )


def strain_phenotypes(spark, sf_dir):
    """Suppliers as strains, line items as statements, orders as phenotypes; customers in credit
    are the terms, so that some phenotypes have no name."""
    table = tables(spark, sf_dir)
    supplier = table("supplier")
    return strain_phenotype(
        supplier.select(F.col("s_suppkey").alias("dbxref_id")),
        supplier.select(F.col("s_suppkey").alias("dbxref_id"), F.col("s_name").alias("accession")),
        table("lineitem").select(
            F.col("l_suppkey").alias("genotype_id"), F.col("l_orderkey").alias("phenotype_id")
        ),
        supplier.select(F.col("s_suppkey").alias("genotype_id"), F.col("s_name").alias("uniquename")),
        table("orders").select(
            F.col("o_orderkey").alias("phenotype_id"), F.col("o_custkey").alias("observable_id"),
            F.col("o_orderdate").alias("timecreated"),
        ),
        table("customer").where(F.col("c_acctbal") >= 0).select(
            F.col("c_custkey").alias("cvterm_id"), F.col("c_name").alias("name")
        ),
    )


def described_entity_rows(spark, sf_dir):
    """Parts described by their line items; the term is the supplier's region, a name shared by
    many term ids; the reference is the nation the part's size points to, where there is one."""
    table = tables(spark, sf_dir)
    terms = (
        table("supplier")
        .join(table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("cvterm_id"), F.col("r_name").alias("name"))
    )
    return described_entities(
        table("part").select(
            F.col("p_partkey").alias("feature_id"), F.col("p_name").alias("uniquename"),
            F.col("p_size").alias("dbxref_id"),
        ),
        table("lineitem").select(
            F.col("l_orderkey").alias("featureprop_id"), F.col("l_partkey").alias("feature_id"),
            F.col("l_suppkey").alias("type_id"), F.col("l_returnflag").alias("value"),
            F.col("l_shipdate").alias("timecreated"), F.col("l_linestatus").alias("created_by"),
        ),
        terms,
        table("nation").select(
            F.col("n_nationkey").alias("dbxref_id"), F.col("n_name").alias("accession")
        ),
        term_name="ASIA",
    )


def described_entities_file(spark, sf_dir):
    """Times of the descriptions as the export writes them, with their line numbers."""
    path = scratch_path(spark, "described_entities_file")
    write_lines(described_entity_rows(spark, sf_dir), path, "createdOn")
    return _written_lines(spark, path)


# --- long text, inventory, JSON -------------------------------------------------------------


def _with_line_ends(table) -> DataFrame:
    """Documents with the line ends of several systems, one kind per language."""
    line_end = (
        F.when(F.col("lang") == "en", "\r\n").when(F.col("lang") == "fr", "\r").otherwise("\n")
    )
    text = F.replace(F.concat("text", F.lit("\n")), F.lit("\n"), line_end)
    return table("documents").select("doc_id", "lang", text.alias("text"))


def long_text_export(spark, sf_dir):
    """Typed long text; a document's type is its curator label."""
    table = tables(spark, sf_dir)
    labels = table("labels").select("doc_id", F.col("quality").alias("feature_type"))
    return longtext.long_text_export(
        _with_line_ends(table), "doc_id", "text", labels, "doc_id", "feature_type"
    )


def long_text_values(spark, sf_dir):
    """Untyped long text, whole documents; those of a side table that lacks them have none."""
    table = tables(spark, sf_dir)
    rows = table("labels").select("doc_id").union(table("documents").select("doc_id")).distinct()
    return longtext.long_text_export(rows.join(_with_line_ends(table), "doc_id", "left"), "doc_id", "text")


def _text_columns(table) -> tuple[DataFrame, longtext.TextTable]:
    labelled = table("documents").join(table("labels"), "doc_id", "left").select(
        F.col("doc_id").alias("DOC_ID"),
        F.col("text").alias("BODY"),
        F.when(F.col("quality") == 1, F.col("source")).alias("ORIGIN"),
    )
    return labelled, longtext.TextTable("doc", ("BODY", "ORIGIN"), longtext.id_column("DOC"))


def text_columns_export(spark, sf_dir):
    rows, spec = _text_columns(tables(spark, sf_dir))
    return longtext.as_text(longtext.text_columns_export(rows, spec))


def text_columns_csv(spark, sf_dir):
    """The same through a CSV folder: written, then read back."""
    path = scratch_path(spark, "text_columns_csv")
    rows = text_columns_export(spark, sf_dir)
    write_csv(rows, path)
    return spark.read.schema(rows.schema).options(**CSV_READ).option("header", True).csv(path).select(
        *[F.coalesce(c, F.lit("")).alias(c) for c in rows.columns]
    )


def text_columns_renamed(spark, sf_dir):
    """The same under other header names, which are taken from the written files."""
    rows, spec = _text_columns(tables(spark, sf_dir))
    spec = replace(spec, rename={"BODY": "Full text", "ORIGIN": "Origin"})
    path = scratch_path(spark, "text_columns_renamed")
    write_csv(longtext.as_text(longtext.text_columns_export(rows, spec), spec.rename), path)
    written = spark.read.options(**CSV_READ).option("header", True).csv(path)
    return written.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in written.columns])


def text_column_inventory(spark, sf_dir):
    views = known_rows(spark, [(v,) for v in VIEWS], "mview_name string")
    return longtext.text_column_inventory(_frames(spark, sf_dir), views, EXCLUDED)


def text_export_specs(spark, sf_dir):
    columns = longtext.populated_text_columns(_catalog(spark, sf_dir), OWNER, EXCLUDED)
    return longtext.text_export_specs(columns).withColumn("columns", F.array_join("columns", "|"))


def text_export_specs_filled(spark, sf_dir):
    """By the columns that hold any value rather than by a catalog's row counts."""
    frames = FileTables(spark, sf_dir).footer_frames(TABLES)
    views = known_rows(spark, [(v,) for v in VIEWS], "mview_name string")
    columns = longtext.filled_text_columns(frames, views, EXCLUDED)
    return longtext.text_export_specs(columns).withColumn("columns", F.array_join("columns", "|"))


def text_export_specs_by_name(spark, sf_dir):
    """Upper-case tables, two of which have an id column of their own."""
    frames = _frames(spark, sf_dir)
    named = {"PARAGRAPH": frames["conversations"], "PLASMID": frames["pages"], "CVTERM": frames["documents"]}
    columns = longtext.populated_text_columns(frames_catalog(spark, named, OWNER), OWNER)
    return longtext.text_export_specs(columns).withColumn("columns", F.array_join("columns", "|"))


def owned_text_columns(spark, sf_dir):
    """Filled text columns of two owners who share table names."""
    catalog = _two_owners(spark, sf_dir)
    first, second = (
        longtext.populated_text_columns(catalog, o, EXCLUDED).withColumn("owner", F.lit(o)) for o in (OWNER, OTHER_OWNER)
    )
    return first.unionByName(second)


def table_name_list(spark, sf_dir):
    return longtext.table_names(_catalog(spark, sf_dir), OWNER)


def own_space_table_names(spark, sf_dir):
    return longtext.own_space_table_names(_two_owners(spark, sf_dir), OWNER)


def table_name_clean(spark, sf_dir):
    return clean_names(tables(spark, sf_dir)("pages").select("page_id", "url"), "url")


def composite_anti(spark, sf_dir):
    lineitem = tables(spark, sf_dir)("lineitem")
    keys = ["l_partkey", "l_suppkey"]
    returned = lineitem.where(F.col("l_returnflag") == "R").select(*keys).distinct()
    return membership.not_exists(lineitem.select(*keys).distinct(), returned, keys)


def table_json(spark, sf_dir):
    """Whole tables as JSON objects; a left join gives the documents NULL fields to keep."""
    table = tables(spark, sf_dir)
    labelled = table("documents").join(table("labels"), "doc_id", "left")
    frames = {
        "documents": labelled, "conversations": table("conversations"), "pages": table("pages"),
        "nation": table("nation"), "region": table("region"),
    }
    parts = [
        longtext.table_json(df).select(F.lit(name).alias("table_name"), "json")
        for name, df in frames.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


LISTED = ("  pages", "region;", "", "nation\r", "conversations", "pages")


def listed_tables_json(spark, sf_dir):
    """Whole tables named by the lines of a file, written as JSON and read back."""
    listed, folder = (scratch_path(spark, n) for n in ("table_list", "listed_tables"))
    write_lines(known_rows(spark, [(v,) for v in LISTED], "value string"), listed, "value")
    chado.export_listed_tables_json(spark, FileTables(tuned(spark), sf_dir), listed, folder)
    rows = spark.read.option("lineSep", "\n").text(f"{folder}/*.json")
    name = F.regexp_extract(F.col("_metadata.file_path"), r"/(\w+)\.json/", 1)
    return rows.select(name.alias("table_name"), F.col("value").alias("json"))


def table_scan_balanced(spark, sf_dir):
    """Ranges of equal row counts; the ids of the later orders are spread a thousand times as far."""
    rows = tables(spark, sf_dir)("lineitem").select(
        F.when(F.col("l_orderkey") % 4 == 0, F.col("l_orderkey") * 1000).otherwise(F.col("l_orderkey")).alias("id")
    )
    return balanced_ranges(rows, "id", -(-rows.count() // SCAN_RANGES))


def text_export_specs_registered(spark, sf_dir):
    """The same from Spark's own catalog, in which the tables are registered as global temporary views."""
    database = spark.conf.get("spark.sql.globalTempDatabase")
    for name, df in FileTables(spark, sf_dir).footer_frames(TABLES).items():
        df.createOrReplaceGlobalTempView(name)
    catalog = spark_catalog(spark, database, VIEWS, session_views=False)
    columns = longtext.populated_text_columns(catalog, database, EXCLUDED).where(F.col("table_name").isin(*TABLES))
    return longtext.text_export_specs(columns).withColumn("columns", F.array_join("columns", "|"))


def table_scan_partitioned(spark, sf_dir):
    return id_ranges(tables(spark, sf_dir)("lineitem").select("l_orderkey"), "l_orderkey", SCAN_RANGES)


# --- GFF3 -----------------------------------------------------------------------------------


def gff3_from_parts(table) -> DataFrame:
    """One line per part, one file per brand. The part's number decides type and attributes;
    its size makes some lines comments, blank, short, or the end mark of the features."""
    key = F.col("p_partkey")
    number = key.cast("string")
    type_name = (
        F.when(key % 4 == 0, "polypeptide").when(key % 4 == 1, "gene").otherwise("mRNA")
    )
    ident = F.concat(F.lit("ID=P"), number)
    attributes = (
        F.when(key % 6 == 0, F.concat(ident, F.lit(";Dbxref=GeneID:"), number))
        .when(key % 6 == 1, F.concat(ident, F.lit(";Dbxref=GeneID:"), number, F.lit(",SGD:"), number, F.lit(";Name="), "p_name"))
        .when(key % 6 == 2, F.concat(ident, F.lit(";Dbxref=SGD:"), number))
        .when(key % 6 == 3, F.concat(ident, F.lit(";Name="), "p_name"))
        .when(key % 6 == 4, F.concat(ident, F.lit(";Dbxref=GeneID:"), number, F.lit(",NCBI_GP:"), number))
        .otherwise(F.concat(ident, F.lit(";Dbxref=SGD:1;Dbxref=GeneID:"), number))
    )
    start = key + 1
    feature = F.concat_ws(
        "\t", "p_brand", "p_type", type_name, start.cast("string"),
        (start + F.col("p_size")).cast("string"), F.lit("."),
        F.when(key % 2 == 0, "+").otherwise("-"), F.lit("."), attributes,
    )
    size = F.col("p_size")
    value = (
        F.when(size == 50, "###")
        .when(size == 49, F.concat(F.lit("## Dbxref=GeneID:"), number))
        .when(size == 48, F.concat_ws("\t", "p_brand", F.lit("Dbxref"), F.lit("polypeptide")))
        .when(size == 47, "")
        .otherwise(feature)
    )
    return table("part").select(
        F.concat(F.lit("/genomes/"), F.replace("p_brand", F.lit("#"), F.lit("_")), F.lit(".v1.gff3")).alias("file"),
        F.lit(0).cast("long").alias("block"),
        key.alias("id"),
        value.alias("value"),
    )


def gff3_line_fields(spark, sf_dir):
    return gff3_fields(gff3_from_parts(tables(spark, sf_dir))).drop("block")


def dbxref_clean(spark, sf_dir):
    lines = gff3_from_parts(tables(spark, sf_dir))
    return gff3_lines.clean_dbxref(lines, REMOVED_DATABASES).drop("block")


def _split(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    lines = gff3_from_parts(tables(spark, sf_dir))
    marks = staged(gff3_lines.file_marks(lines), "gff3_marks")
    return gff3_lines.split_by_type(lines, marks=marks), marks


def gff3_split_kept(spark, sf_dir):
    kept = gff3_lines.kept_lines(_split(spark, sf_dir)[0]).drop("block")
    return kept.withColumn("output", split_file_name(F.col("file"), gff3_lines.KEPT_SUFFIX))


def gff3_split_poly(spark, sf_dir):
    poly = gff3_lines.split_lines(*_split(spark, sf_dir)).drop("block")
    return poly.withColumn("output", split_file_name(F.col("file"), gff3_lines.SPLIT_SUFFIX))


def gff3_file_clean(spark, sf_dir):
    """The clean-up on files: lines are written in order, one folder per file, and read back."""
    table = tables(spark, sf_dir)
    path = scratch_path(spark, "gff3_file_clean")
    lines = gff3_from_parts(table).withColumn("stem", F.substring_index(F.substring_index("file", "/", -1), ".", 1))
    write_ordered_lines(lines, path, POSITION, partition_by=["stem"])
    stem = F.regexp_extract("file", "stem=([^/]+)/", 1)
    cleaned = gff3_lines.clean_dbxref(read_lines(spark, path), REMOVED_DATABASES)
    return cleaned.select(stem.alias("stem"), "value")


def gff3_file_split(spark, sf_dir):
    """The split on files: lines are written in order and read back with their line numbers."""
    table = tables(spark, sf_dir)
    path, split = (scratch_path(spark, f"gff3_{n}") for n in ("whole", "split"))
    lines = gff3_from_parts(table).withColumn("stem", F.substring_index(F.substring_index("file", "/", -1), ".", 1))
    write_ordered_lines(lines, path, POSITION, partition_by=["stem"])
    # A stem's part files count as one file, whose blocks are led by the number of the part.
    part = F.regexp_extract("file", r"part-(\d+)", 1).cast("long")
    whole = read_lines(spark, path).withColumn("block", part * 2**40 + F.col("block")).withColumn(
        "file", F.concat(F.regexp_extract("file", "stem=([^/]+)/", 1), F.lit(".gff3"))
    )
    chado.split_placed(whole, split)
    output = F.regexp_extract("file", "output=([^/]+)/", 1)
    return numbered(read_lines(spark, split).withColumn("output", output), ["output"]).select("output", "line_number", "value")


def gff3_file_split_ordered(spark, sf_dir):
    """The split on files with one sequence of part files per output: two folders, sorted by ranges."""
    table = tables(spark, sf_dir)
    kept, poly = (scratch_path(spark, f"gff3_{n}") for n in ("kept", "poly"))
    chado.split_polypeptides(gff3_from_parts(table), kept, poly)
    output = F.regexp_extract("file", "output=([^/]+)/", 1)
    first, second = (
        numbered(read_lines(spark, p).withColumn("output", output), ["output"]) for p in (kept, poly)
    )
    return first.unionByName(second).select("output", "line_number", "value")


def gff3_stream_split(spark, sf_dir):
    """The split of files that arrive in a folder, two or more batches of them, read back with line numbers."""
    table = tables(spark, sf_dir)
    path, whole, split, marks = (scratch_path(spark, f"gff3_{n}") for n in ("arriving", "files", "streamed", "checkpoint"))
    # Files as they arrive have no part number in their name: a part's lines are one file.
    lines = gff3_from_parts(table).withColumn("stem", F.substring_index(F.substring_index("file", "/", -1), ".", 1))
    lines = lines.repartition("stem").sortWithinPartitions("stem", *POSITION)
    write_lines(lines, path, "value", ["stem"])
    named(spark, path, whole)
    split_polypeptide_stream(spark, whole, split, marks, files_per_batch=16).awaitTermination()
    output = F.regexp_extract("file", "output=([^/]+)/", 1)
    return numbered(read_lines(spark, split).withColumn("output", output), ["output"]).select("output", "line_number", "value")


def named(spark: SparkSession, path: str, to: str) -> None:
    """Moves the one part file of each ``stem=<name>`` folder to ``<name>.v1.gff3`` below ``to``."""
    jvm = spark._jvm.org.apache.hadoop.fs
    system = jvm.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(jvm.Path(to))
    for found in system.globStatus(jvm.Path(f"{path}/stem=*/part-*")):
        stem = found.getPath().getParent().getName().removeprefix("stem=")
        system.rename(found.getPath(), jvm.Path(f"{to}/{stem}.v1.gff3"))


def gff3_file_placed(spark, sf_dir):
    """The clean-up as exported: a folder per file and split, read back with line numbers."""
    table = tables(spark, sf_dir)
    path, out = (scratch_path(spark, f"gff3_{n}") for n in ("input", "placed"))
    write_ordered_lines(gff3_from_parts(table), path, POSITION)
    chado.clean_dbxref_files(spark, path, out, REMOVED_DATABASES)
    return _written_lines(spark, out)


# --- slices, checks, reports ----------------------------------------------------------------


def slice_export(spark, sf_dir):
    """Orders by status and priority in the shape of the organism slices."""
    filters = {
        "genus": F.col("o_orderstatus"), "species": F.col("o_orderpriority"),
        "exclude_big": F.col("o_totalprice") < 250000, "only_big": F.col("o_totalprice") >= 250000,
    }
    options = {
        "finished": {"genus": "F"},
        "open": {"genus": "O", "species": "1-URGENT", "exclude_big": "1"},
        "open_big": {"genus": "O", "species": "1-URGENT", "only_big": "1"},
    }
    wanted = [
        slices.Slice(*slices.organism_slice_name(k), slices.option_filter(o, filters))
        for k, o in options.items()
    ] + [slices.Slice("all", "canonical_core")]
    rows = tables(spark, sf_dir)("orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"
    )
    return slices.slice_export(rows, wanted).select("folder", "name", "o_orderkey")


def slice_files(spark, sf_dir):
    """The same through one folder per slice, read back with the folders as columns."""
    path = scratch_path(spark, "slice_files")
    write_csv(slice_export(spark, sf_dir), path, partition_by=["folder", "name"])
    schema = "o_orderkey long, folder string, name string"
    return spark.read.schema(schema).options(**CSV_READ).option("header", True).csv(path)


def slice_export_optional(spark, sf_dir):
    """Line items by flags that may be absent, in the shape of the alignment slices."""
    filters = {
        "organism": F.col("l_linestatus"), "reference_type": F.col("l_returnflag"),
        "feature_type": F.col("l_linenumber").cast("string"), "match_type": F.col("l_quantity").cast("int").cast("string"),
    }
    options = {
        "open": {"organism": "O"},
        "open_returned": {"organism": "O", "reference_type": "R"},
        "first_returned": {"reference_type": "R", "feature_type": "1"},
        "first_ten": {"organism": "F", "reference_type": "A", "feature_type": "1", "match_type": "10"},
    }
    wanted = [slices.Slice("lines", k, slices.option_filter(o, filters)) for k, o in options.items()]
    rows = tables(spark, sf_dir)("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linestatus", "l_returnflag", "l_linenumber", "l_quantity"
    )
    return slices.slice_export(rows, wanted).select("name", "l_orderkey", "l_partkey", "l_suppkey")


def class_slice_export(spark, sf_dir):
    """Parts by feature class; one class more than there are slices."""
    classes = F.array(*[F.lit(c) for c in (*chado.CLASS_SLICES, "other")])
    wanted = chado.class_slices(F.get(classes, F.col("p_size") % (len(chado.CLASS_SLICES) + 1)))
    rows = tables(spark, sf_dir)("part").select("p_partkey", "p_size")
    return slices.slice_export(rows, wanted).select("folder", "name", "p_partkey")


def visibility_split(spark, sf_dir):
    table = tables(spark, sf_dir)
    notes = table("documents").join(table("labels"), "doc_id", "left").select("doc_id", "text", "toxic")
    return slices.visibility_split(notes, F.col("toxic") == 1).select("doc_id", "visibility", "text")


def required_value_violations(spark, sf_dir):
    table = tables(spark, sf_dir)
    labelled = table("documents").join(table("labels"), "doc_id", "left")
    return required_violations(labelled, ["doc_id", "text", "quality", "toxic"])


def unregistered_tables(spark, sf_dir):
    """Filled text columns of tables that are not in the registry, with their statistics."""
    frames = _frames(spark, sf_dir)
    registry = longtext.registry_frame(spark, REGISTERED)
    return unregistered(longtext.column_statistics(frames), registry)


def export_report(spark, sf_dir):
    """Whole tables written as JSON, CSV or lines. One has columns without a text form: it is
    reported, and the others are still written."""
    table = tables(spark, sf_dir)
    folder = scratch_path(spark, "export_report")

    def export(name, write, build=None):
        return Export(name, build or (lambda: table(name)), write, f"{folder}/{name}")

    exports = [
        *(export(n, write_json) for n in ("documents", "conversations", "embeddings", "nation")),
        *(export(n, write_csv) for n in ("customer", "orders", "lineitem", "events")),
        export("benchmark", lambda df, path: write_lines(df, path, "text")),
        export("no_text_form", write_csv, lambda: longtext.as_text(table("embeddings"))),
    ]
    return export_tables(spark, exports, on_violation="report").select("name", "status", "row_count")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "order_manifest": order_manifest,
    "order_manifest_csv": order_manifest_csv,
    "order_manifest_file": order_manifest_file,
    "order_manifest_items": order_manifest_items,
    "order_manifest_by_id": order_manifest_by_id,
    "order_contacts": order_contacts,
    "order_contacts_file": order_contacts_file,
    "order_catalog_items": order_catalog_items,
    "order_other_items": order_other_items,
    "order_other_items_by_id": order_other_items_by_id,
    "entity_provenance": entity_provenance_rows,
    "accession_provenance": accession_provenance_file,
    "lookup_misses": lookup_misses,
    "lookup_value_misses": lookup_value_misses,
    "strain_phenotype": strain_phenotypes,
    "described_entities": described_entity_rows,
    "described_entities_file": described_entities_file,
    "long_text_export": long_text_export,
    "long_text_values": long_text_values,
    "text_columns_export": text_columns_export,
    "text_columns_csv": text_columns_csv,
    "text_columns_renamed": text_columns_renamed,
    "text_column_inventory": text_column_inventory,
    "text_export_specs": text_export_specs,
    "text_export_specs_by_name": text_export_specs_by_name,
    "text_export_specs_filled": text_export_specs_filled,
    "text_export_specs_registered": text_export_specs_registered,
    "owned_text_columns": owned_text_columns,
    "table_name_list": table_name_list,
    "own_space_table_names": own_space_table_names,
    "table_name_clean": table_name_clean,
    "composite_anti": composite_anti,
    "table_json": table_json,
    "listed_tables_json": listed_tables_json,
    "table_scan_partitioned": table_scan_partitioned,
    "table_scan_balanced": table_scan_balanced,
    "gff3_lines": gff3_line_fields,
    "dbxref_clean": dbxref_clean,
    "gff3_split_kept": gff3_split_kept,
    "gff3_split_poly": gff3_split_poly,
    "gff3_file_clean": gff3_file_clean,
    "gff3_file_placed": gff3_file_placed,
    "gff3_file_split": gff3_file_split,
    "gff3_file_split_ordered": gff3_file_split_ordered,
    "gff3_stream_split": gff3_stream_split,
    "slice_export": slice_export,
    "slice_files": slice_files,
    "slice_export_optional": slice_export_optional,
    "class_slice_export": class_slice_export,
    "visibility_split": visibility_split,
    "required_violations": required_value_violations,
    "unregistered_tables": unregistered_tables,
    "export_report": export_report,
}
