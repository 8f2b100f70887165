"""The exports under the names of the genome and stock database's own tables.

``source`` is anything with ``table(name)``. Each function reads, derives and writes one export.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from annexport.functions.text import export_file_name, prefixed_id, split_file_name
from annexport.operators import gff3 as gff3_lines
from annexport.operators.checks import (
    RequiredCounts, RequiredValueError, require_unique, require_values, required_violations, unregistered,
    written_if_clean,
)
from annexport.operators.descriptions import described_entities
from annexport.operators.longtext import (
    LONG_TEXT,
    as_text,
    has_text,
    id_column,
    long_text_export,
    own_space_table_names,
    populated_text_columns,
    registered_table,
    registry_frame,
    table_names,
    text_columns_export,
    whole_id,
)
from annexport.operators.orders import flagged_order_items, labels_by_id, manifest_csv, manifest_of, unlabelled_stocks
from annexport.operators.phenotype import strain_phenotype, unnamed_strains
from annexport.operators.provenance import entity_provenance
from annexport.operators.slices import Slice, organism_slice_name, option_filter, slice_export, visibility_split
from annexport.plans.exports import Export, export_tables
from annexport.session import discard, staging
from annexport.sinks.files import (
    write_csv, write_json, write_lines, write_ordered_lines, write_output_lines, write_placed_lines,
)
from annexport.sources.catalog import Catalog
from annexport.sources.rows import known_rows
from annexport.sources.text import POSITION, read_lines, read_name_list

# Organisms exported besides the default one, with their options.
ORGANISM_SLICES = {
    "purpureum": {"genus": "Dictyostelium", "species": "purpureum"},
    "pallidum": {"genus": "Polysphondylium", "species": "pallidum PN500"},
    "pallidum_mitochondrial": {"genus": "Polysphondylium", "species": "pallidum CK8"},
    "fasciculatum": {
        "genus": "Dictyostelium",
        "species": "fasciculatum SH3",
        "exclude_mitochondrial": "1",
    },
    "fasciculatum_mitochondrial": {
        "genus": "Dictyostelium",
        "species": "fasciculatum SH3",
        "only_mitochondrial": "1",
    },
}
DEFAULT_ORGANISM = "discoideum"
DEFAULT_SLICE = "canonical_core"

# Feature classes of the default organism that are exported on their own.
CLASS_SLICES = (
    "canonical_noncoding",
    "noncanonical_seq_center",
    "noncanonical_norepred",
    "noncanonical_curated",
)

# Alignment exports, named after their feature type.
ALIGNMENT_SLICES = (
    {"organism": "dicty", "reference_type": "chromosome", "feature_type": "EST"},
    {"organism": "dicty", "reference_type": "chromosome", "feature_type": "cDNA_clone"},
    {
        "organism": "dicty",
        "reference_type": "chromosome",
        "feature_type": "databank_entry",
        "match_type": "nucleotide_match",
    },
)


# Lookups that the phenotype export need not join, because their keys are unique.
UNREAD_LOOKUPS = {"cvterm": "cvterm_id"}

# What the exports of orders, users, phenotypes and descriptions read, for ``StagedTables``.
READ_COLUMNS = {
    "stock_order": ("stock_order_id", "order_date", "colleague_id"),
    "colleague": ("colleague_no",),
    "coll_email": ("colleague_no", "email_no"),
    "email": ("email_no", "email"),
    "stock_item_order": ("stock_item_order_id", "order_id", "item_id", "item"),
    "plasmid": ("id", "name", "created_by", "date_created", "date_modified"),
    "stock_center": ("id", "dbxref_id", "created_by", "date_created", "date_modified"),
    "dbxref": ("dbxref_id", "accession"),
    "phenstatement": ("genotype_id", "phenotype_id"),
    "genotype": ("genotype_id", "uniquename"),
    "phenotype": ("phenotype_id", "observable_id", "timecreated"),
    "cvterm": ("cvterm_id", "name"),
    "v_gene_features": ("feature_id", "uniquename", "dbxref_id"),
    "featureprop": ("featureprop_id", "feature_id", "type_id", "value", "timecreated", "created_by"),
}


def order_frames(source) -> dict[str, DataFrame]:
    """Order tables under the operators' column names."""
    orders = source.table("stock_order").select(
        F.col("stock_order_id").alias("order_id"), "order_date",
        F.col("colleague_id").alias("colleague_no"),
    )
    contacts = (
        orders.join(source.table("colleague").select("colleague_no"), "colleague_no")
        .join(source.table("coll_email").select("colleague_no", "email_no"), "colleague_no")
        .join(source.table("email").select("email_no", F.col("email").alias("contact")), "email_no")
        .select("order_id", "order_date", "contact")
    )
    return {
        "contacts": contacts,
        "items": source.table("stock_item_order").select(
            "stock_item_order_id", "order_id", "item_id", "item"
        ),
        "catalog": source.table("plasmid").select(
            F.col("name").alias("item"), F.col("name").alias("catalog_label")
        ).distinct(),
        "stocks": source.table("stock_center").select(F.col("id").alias("item_id"), "dbxref_id")
        .join(source.table("dbxref").select("dbxref_id", "accession"), "dbxref_id")
        .select("item_id", F.col("accession").alias("stock_label")),
    }


def export_orders(source, path: str) -> None:
    """One CSV line per order and e-mail: date, e-mail, plasmids, strains; sorted by date, e-mail.

    An order's strains are told from its plasmids by item id. An ordered strain without accession
    stops the export.
    """
    frames = order_frames(source)
    contacts, items, catalog, stocks = (frames[k] for k in ("contacts", "items", "catalog", "stocks"))
    with staging(items.sparkSession) as stage:
        labels = staged_labels(stage, items, catalog, stocks, "item", "item_id", "stock_item_order_id")
        lines = manifest_csv(manifest_of(contacts, labels)).orderBy("order_date", "contact", "order_id")
        required = RequiredCounts()
        written_if_clean(
            required.of(lines, ["order_date", "contact"]), path, required, lambda rows, to: write_lines(rows, to, "line")
        )


def staged_labels(
    stage: Callable[[DataFrame, str], DataFrame], items: DataFrame, catalog: DataFrame, stocks: DataFrame,
    on: str, stock_on: str, item_id: str,
) -> DataFrame:
    """Labels of the orders by item id. The items are read once, by the job that stages what is needed of
    them; it also counts the stocks without a label, which raise, and the NULL ids."""
    seen = Observation()
    flagged = flagged_order_items(items, catalog, stocks, on, stock_on, item_id).observe(
        seen, F.count_if(unlabelled_stocks()).alias("unlabelled"), F.count_if(F.col("item_id").isNull()).alias("null_ids")
    )
    flagged = stage(flagged, "flagged_items")
    if seen.get["unlabelled"]:
        raise RequiredValueError(f"stock_label is NULL for {seen.get['unlabelled']} ordered items")
    return labels_by_id(flagged, bool(seen.get["null_ids"]))


def export_users(source, plasmid_path: str, strain_path: str) -> None:
    """Who made each plasmid and strain: headerless CSV."""
    columns = ["created_by", "date_created", "date_modified"]
    required = RequiredCounts()
    plasmids = required.of(source.table("plasmid").select("id", *columns), ["id", *columns])
    ids = entity_provenance(plasmids, prefixed_id(F.col("id"), "DBP", 7))
    written_if_clean(ids, plasmid_path, required, lambda rows, path: write_csv(rows, path, header=False))
    required = RequiredCounts()
    strains = required.of(source.table("stock_center").select("dbxref_id", *columns), columns)
    accessions = source.table("dbxref").select("dbxref_id", "accession")
    # A strain whose entry has no accession is counted in the joined rows; one without an entry is left out.
    joined = required.of(strains.join(accessions, "dbxref_id"), ["accession"])
    rows = entity_provenance(joined, F.col("accession"))
    written_if_clean(rows, strain_path, required, lambda rows, path: write_csv(rows, path, header=False))


def export_strain_phenotypes(
    source, path: str, on_violation: str = "fail", unread: Mapping[str, str] = UNREAD_LOOKUPS
) -> DataFrame:
    """Returns ``column_name, violations``: strains without accession, rows without the other values.

    The rows are joined once, staged, checked and written. Lookups that add no output column are
    not joined; under ``fail`` the key of each table in ``unread`` (name, key) must be unique, as a
    repeated one would have multiplied rows.
    """
    if on_violation == "fail":
        for table, key in unread.items():
            require_unique(source.table(table).select(key), [key], table)
    strains = source.table("stock_center")
    accessions = source.table("dbxref").select("dbxref_id", "accession")
    rows = strain_phenotype(
        strains,
        accessions,
        source.table("phenstatement").select("genotype_id", "phenotype_id"),
        source.table("genotype").select("genotype_id", "uniquename"),
        source.table("phenotype").select("phenotype_id", "observable_id", "timecreated"),
        source.table("cvterm").select("cvterm_id", "name"),
        on_violation,
    )
    required = ["phenotype", "createdOn"]
    unnamed = unnamed_strains(strains, accessions).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("violations")
    )
    with staging(rows.sparkSession) as stage:
        rows = stage(rows, "strain_phenotypes")
        write_csv(require_values(rows, required, on_violation), path)
        counts = unnamed.select(F.lit("accession").alias("column_name"), "violations").unionByName(
            required_violations(rows, required)
        ).collect()
    return known_rows(rows.sparkSession, [tuple(r) for r in counts], "column_name string, violations long")


def export_gene_descriptions(source, path: str, on_violation: str = "fail") -> None:
    rows = described_entities(
        source.table("v_gene_features").select("feature_id", "uniquename", "dbxref_id"),
        source.table("featureprop").select(
            "featureprop_id", "feature_id", "type_id", "value", "timecreated", "created_by"
        ),
        source.table("cvterm").select("cvterm_id", "name"),
        source.table("dbxref").select("dbxref_id", "accession"),
    )
    required = RequiredCounts()
    written_if_clean(required.of(rows, rows.columns), path, required, write_csv, on_violation)


def export_long_text(
    spark: SparkSession, source, catalog: Catalog, owner: str, folder: str,
    empty_is_null: bool | None = None, on_violation: str = "fail",
) -> DataFrame:
    """Every filled long text column of the owner's tables, one CSV folder per table.

    Tables found but not registered stop the export before anything is written. The list that
    reaches the driver has one row per table. Whether an empty text counts as none is the source's
    own matter unless ``empty_is_null`` says it.
    """
    empty_is_null = source.empty_is_null if empty_is_null is None else empty_is_null
    columns = populated_text_columns(catalog, owner)
    unknown = unregistered(columns, registry_frame(spark)).select("table_name").distinct().collect()
    if unknown:
        raise KeyError("unregistered tables: " + ", ".join(sorted(r.table_name for r in unknown)))
    found = (
        columns.groupBy("table_name")
        .agg(F.sort_array(F.collect_list("column_name")).alias("columns"))
        .withColumn("output_file", export_file_name(F.col("table_name")))
        .collect()
    )

    def export(row) -> Export:
        spec = registered_table(row.table_name)

        def build() -> DataFrame:
            # Only catalogued columns are read; the registered layout decides what is written,
            # so a registered column without catalog entry is an empty field.
            frame = source.table(row.table_name)
            filled = frame.where(has_text(row.columns, empty_is_null)).select(
                id_column(row.table_name), *row.columns
            )
            missing = {c: F.lit(None).cast("string") for c in spec.columns if c not in row.columns}
            rows = filled.withColumns(missing).select(spec.id_column, *spec.columns)
            return as_text(whole_id(rows, spec.id_column))

        return Export(row.table_name, build, write_csv, f"{folder}/{row.output_file}")

    return export_tables(spark, [export(r) for r in found], on_violation)


def export_registered_table(source, name: str, path: str, empty_is_null: bool | None = None) -> None:
    """One registered table's long text, without looking at a catalog."""
    empty_is_null = source.empty_is_null if empty_is_null is None else empty_is_null
    spec = registered_table(name)
    rows = text_columns_export(source.table(name), spec, empty_is_null)
    write_csv(as_text(whole_id(rows, spec.id_column)), path)


def export_table_names(catalog: Catalog, owner: str, path: str) -> None:
    write_lines(table_names(catalog, owner), path, "table_name")


def export_own_space_table_names(catalog: Catalog, owner: str, path: str) -> None:
    write_lines(own_space_table_names(catalog, owner), path, "table_name")


def export_tables_json(
    spark: SparkSession, source, names: Iterable[str], folder: str, on_violation: str = "fail"
) -> DataFrame:
    """Whole tables as JSON lines; a table that cannot be read does not stop the others."""

    def export(name: str) -> Export:
        return Export(name, lambda: source.table(name), write_json, f"{folder}/{name}.json")

    return export_tables(spark, [export(n) for n in names], on_violation)


def export_listed_tables_json(
    spark: SparkSession, source, list_path: str, folder: str, on_violation: str = "fail"
) -> DataFrame:
    """The same for the tables named in a file, one per line. Only their names reach the driver."""
    names = [r.table_name for r in read_name_list(spark, list_path).distinct().collect()]
    return export_tables_json(spark, source, sorted(names), folder, on_violation)


def export_feature_residues(source, path: str) -> None:
    types = source.table("cvterm").select(
        F.col("cvterm_id").alias("type_id"), F.col("name").alias("feature_type")
    )
    features = source.table("feature").select("feature_id", "type_id", "residues")
    write_csv(long_text_export(features, "feature_id", "residues", types), path, header=False)


def export_featureprop_values(source, path: str) -> None:
    properties = source.table("featureprop").select("featureprop_id", "value")
    write_csv(long_text_export(properties, "featureprop_id", "value"), path, header=False)


def clean_dbxref_files(
    spark: SparkSession, paths: str | Sequence[str], path: str, names: Sequence[str],
    ordered: bool = True, one_sequence: bool = False,
) -> None:
    """Lines keep their order in a folder per file and split, without a shuffle. ``one_sequence``
    sorts all of them by ranges into one sequence of part files instead; ``ordered=False`` writes
    part files in which the order holds only within a split."""
    cleaned = gff3_lines.clean_dbxref(read_lines(spark, paths), names)
    if one_sequence:
        write_ordered_lines(cleaned, path, POSITION)
    elif ordered:
        write_placed_lines(cleaned, path)
    else:
        write_lines(cleaned, path, "value")


def split_polypeptide_files(
    spark: SparkSession, paths: str | Sequence[str], kept_path: str, split_path: str
) -> None:
    """Two folders, each with an ``output=<name>_no_poly.gff3`` or ``_poly.gff3`` folder per input, whose
    part files are one sequence each. ``split_placed_files`` does without the sort that this takes.

    The positions of lines depend on how the files are cut into tasks, and a cluster that grows
    in between may cut them differently. So they are staged before they are compared. Inputs whose
    outputs would have one name stop the export before anything is written.
    """
    split_polypeptides(read_lines(spark, paths), kept_path, split_path)


def split_polypeptides(lines: DataFrame, kept_path: str, split_path: str) -> None:
    """The same for lines with ``file, block, id, value``."""
    with staging(lines.sparkSession) as stage:
        positioned = stage(lines, "gff3_lines")
        marks = stage(gff3_lines.file_marks(positioned), "gff3_marks")
        _write_split(positioned, marks, kept_path, split_path)


def split_placed_files(spark: SparkSession, paths: str | Sequence[str], path: str) -> None:
    """The split without a sort: ``output=<name>/start=<start of a split>`` folders, whose names put the lines of
    an output in order. The version lines have a start before all others."""
    split_placed(read_lines(spark, paths), path)


def split_placed(lines: DataFrame, path: str, attempts: int = 3) -> None:
    """The same for lines with ``file, block, id, value``, of which each split is read by one task.

    The files are read twice, once for the marks and once to tag every line with its output and write it, and
    nothing else moves. Marks hold only if both passes cut the files alike. Each pass sums up, in the job it
    does anyway, a hash of all lines with their positions; if the two differ (a cluster grew in between)
    the output is dropped and both are made again.
    """
    spark = lines.sparkSession
    digest = [F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*POSITION, "value")).alias("digest")]
    for _ in range(attempts):
        with staging(spark) as stage:
            marked, written = Observation(), Observation()
            marks = stage(gff3_lines.file_marks(lines.observe(marked, *digest)), "gff3_marks")
            _require_own_outputs(marks)
            split = gff3_lines.split_by_type(lines.observe(written, *digest), marks=marks)
            write_output_lines(gff3_lines.output_lines(split, marks), path)
            if marked.get == written.get:
                return
        discard(spark, path)
    raise RuntimeError(f"the files were cut differently in each of {attempts} attempts")


def _require_own_outputs(marks: DataFrame) -> None:
    output = split_file_name(F.col("file"), gff3_lines.KEPT_SUFFIX).alias("output")
    shared = marks.groupBy(output).agg(F.count(F.lit(1)).alias("inputs")).where("inputs > 1").first()
    if shared is not None:
        raise ValueError(f"{shared.inputs} inputs would be written to one {shared.output}")


def _write_split(positioned: DataFrame, marks: DataFrame, kept_path: str, split_path: str) -> None:
    _require_own_outputs(marks)
    split = gff3_lines.split_by_type(positioned, marks=marks)
    for lines, path, suffix in (
        (gff3_lines.kept_lines(split), kept_path, gff3_lines.KEPT_SUFFIX),
        (gff3_lines.split_lines(split, marks), split_path, gff3_lines.SPLIT_SUFFIX),
    ):
        named = lines.withColumn("output", split_file_name(F.col("file"), suffix))
        write_ordered_lines(named, path, POSITION, partition_by=["output"])


def organism_slices(filters: dict, default: dict) -> list[Slice]:
    """Slices of all organisms; ``default`` holds the default organism's options."""
    slices = [
        Slice(*organism_slice_name(key), option_filter(options, filters))
        for key, options in ORGANISM_SLICES.items()
    ]
    return [*slices, Slice(DEFAULT_ORGANISM, DEFAULT_SLICE, option_filter(default, filters))]


def class_slices(feature_class) -> list[Slice]:
    return [Slice(DEFAULT_ORGANISM, name, feature_class == F.lit(name)) for name in CLASS_SLICES]


def alignment_slices(filters: dict) -> list[Slice]:
    return [
        Slice(DEFAULT_ORGANISM, options["feature_type"], option_filter(options, filters))
        for options in ALIGNMENT_SLICES
    ]


def export_slices(features: DataFrame, slices: Sequence[Slice], path: str) -> None:
    """One ``folder=``/``name=`` folder per slice, from one scan."""
    write_csv(slice_export(features, slices), path, partition_by=["folder", "name"], rebalanced=True)


def export_notes(notes: DataFrame, is_private, path: str) -> None:
    write_csv(visibility_split(notes, is_private), path, partition_by=["visibility"], rebalanced=True)
