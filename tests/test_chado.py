import glob
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from annexport.operators.checks import RequiredValueError
from annexport.operators.membership import LookupMissError
from annexport.operators.slices import option_filter, organism_slice_name
from annexport.plans import chado
from annexport.sinks.files import CSV_READ
from annexport.sources.catalog import frames_catalog
from annexport.sources.tables import FileTables, StagedTables

T1, T2 = datetime(2010, 5, 6, 7, 8, 9), datetime(2012, 1, 1)
TIME = "timestamp_ntz"

DATABASE = {
    "stock_order": ([(1, T2, 100), (2, T1, 101), (3, T2, 100)], f"stock_order_id long, order_date {TIME}, colleague_id long"),
    "colleague": ([(100,), (101,), (102,)], "colleague_no long"),
    "coll_email": ([(100, 1), (100, 2), (101, 3)], "colleague_no long, email_no long"),
    "email": ([(1, "z@x"), (2, "a@x"), (3, "c@x")], "email_no long, email string"),
    "stock_item_order": (
        [(1, 1, None, "pA"), (2, 1, 10, "strain"), (3, 1, 10, "strain"), (4, 2, 11, "p,B")],
        "stock_item_order_id long, order_id long, item_id long, item string",
    ),
    "plasmid": (
        [(7, "pA", "ann", T1, T2), (12_345_678, "p,B", "bob, jr", T1, T1)],
        f"id long, name string, created_by string, date_created {TIME}, date_modified {TIME}",
    ),
    "stock_center": (
        [(10, 1, "cy", T1, T2), (11, 2, "di", T2, T2)],
        f"id long, dbxref_id long, created_by string, date_created {TIME}, date_modified {TIME}",
    ),
    "dbxref": ([(1, "DBS1"), (2, "DBS2"), (3, "DDB3")], "dbxref_id long, accession string"),
    "phenstatement": ([(1, 1), (1, 2), (2, 3)], "genotype_id long, phenotype_id long"),
    "genotype": ([(1, "DBS1"), (2, "other")], "genotype_id long, uniquename string"),
    "phenotype": ([(1, 5, T1), (2, None, T2), (3, 5, T2)], f"phenotype_id long, observable_id long, timecreated {TIME}"),
    "cvterm": ([(5, "slow"), (6, "description"), (8, "description"), (9, "gene")], "cvterm_id long, name string"),
    "v_gene_features": ([(50, "geneA", 3), (51, "geneB", 3)], "feature_id long, uniquename string, dbxref_id long"),
    "featureprop": (
        [(1, 50, 6, "late\r\ntext\n", T2, "ann"), (2, 51, 8, "early", T1, "bob"), (3, 50, 5, "no", T1, "ann"), (4, 51, 6, "tie", T1, "c")],
        f"featureprop_id long, feature_id long, type_id long, value string, timecreated {TIME}, created_by string",
    ),
    "feature": ([(50, 9, "AC\r\nGT\r\n"), (51, 9, None), (52, None, "A")], "feature_id long, type_id long, residues string"),
}


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("db"))
    for name, (rows, schema) in DATABASE.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return FileTables(spark, root)


def text(path):
    return "".join(open(p, newline="").read() for p in sorted(glob.glob(f"{path}/part-*")))


def records(spark, path, header=False):
    reader = spark.read.options(**CSV_READ).option("header", header)
    return [tuple("" if v is None else v for v in r) for r in reader.csv(path).collect()]


def test_orders(source, tmp_path):
    chado.export_orders(source, str(tmp_path / "o"))
    assert text(tmp_path / "o") == (
        '2010-05-06 07:08:09,c@x,"p,B"\n'
        "2012-01-01 00:00:00,a@x,pA,DBS1\n"
        "2012-01-01 00:00:00,a@x\n"
        "2012-01-01 00:00:00,z@x,pA,DBS1\n"
        "2012-01-01 00:00:00,z@x\n"
    )


def test_users(spark, source, tmp_path):
    chado.export_users(source, str(tmp_path / "p"), str(tmp_path / "s"))
    assert set(records(spark, str(tmp_path / "p"))) == {
        ("DBP0000007", "ann", "2010-05-06 07:08:09", "2012-01-01 00:00:00"),
        ("DBP12345678", "bob, jr", "2010-05-06 07:08:09", "2010-05-06 07:08:09"),
    }
    assert set(records(spark, str(tmp_path / "s"))) == {
        ("DBS1", "cy", "2010-05-06 07:08:09", "2012-01-01 00:00:00"),
        ("DBS2", "di", "2012-01-01 00:00:00", "2012-01-01 00:00:00"),
    }


def test_strain_phenotypes(spark, source, tmp_path):
    with pytest.raises(RequiredValueError, match="phenotype: 1 NULL"):
        chado.export_strain_phenotypes(source, str(tmp_path / "x"))
    chado.export_strain_phenotypes(source, str(tmp_path / "x"), "report")
    assert text(tmp_path / "x").startswith("strain_ID,phenotype,createdOn\n")
    assert set(records(spark, str(tmp_path / "x"), True)) == {
        ("DBS1", "slow", "2010-05-06 07:08:09"), ("DBS1", "", "2012-01-01 00:00:00"),
    }


def test_strain_without_accession(spark, source, tmp_path):
    class Broken:
        def table(self, name):
            df = source.table(name)
            return df.where("dbxref_id <> 2") if name == "dbxref" else df

    with pytest.raises(LookupMissError):
        chado.export_strain_phenotypes(Broken(), str(tmp_path / "x"))


def test_gene_descriptions(spark, source, tmp_path):
    chado.export_gene_descriptions(source, str(tmp_path / "g"))
    assert records(spark, str(tmp_path / "g"), True) == [
        ("geneB", "DDB3", "early", "2010-05-06 07:08:09", "bob"),
        ("geneB", "DDB3", "tie", "2010-05-06 07:08:09", "c"),
        ("geneA", "DDB3", "late\r\ntext\n", "2012-01-01 00:00:00", "ann"),
    ]
    assert text(tmp_path / "g").startswith("name,accession,description,createdOn,createdBy\n")


def test_long_text(spark, source, tmp_path):
    chado.export_feature_residues(source, str(tmp_path / "f"))
    assert records(spark, str(tmp_path / "f")) == [("50", "gene", "AC\nGT")]
    chado.export_featureprop_values(source, str(tmp_path / "v"))
    assert set(records(spark, str(tmp_path / "v"))) == {("1", "late\ntext"), ("2", "early"), ("3", "no"), ("4", "tie")}


def test_tables_json(spark, source, tmp_path):
    report = chado.export_tables_json(spark, source, ["email", "missing", "cvterm"], str(tmp_path / "j"), "report")
    assert {(r.name, r.status) for r in report.collect()} == {("email", "done"), ("cvterm", "done"), ("missing", "failed")}
    assert spark.read.json(f"{tmp_path}/j/email.json").count() == 3


def test_slice_names():
    assert organism_slice_name("purpureum") == ("purpureum", "purpureum_canonical_core")
    assert organism_slice_name("pallidum_mitochondrial") == ("pallidum", "pallidum_canonical_mitochondrial")


def test_organism_slices(spark, tmp_path):
    rows = [
        (1, "Dictyostelium", "purpureum", False), (2, "Polysphondylium", "pallidum PN500", True),
        (3, "Polysphondylium", "pallidum CK8", True), (4, "Dictyostelium", "fasciculatum SH3", True),
        (5, "Dictyostelium", "fasciculatum SH3", False), (6, "Dictyostelium", "discoideum", False), (7, "Homo", "sapiens", False),
    ]
    features = spark.createDataFrame(rows, "id long, genus string, species string, mito boolean")
    filters = {
        "genus": F.col("genus"), "species": F.col("species"),
        "exclude_mitochondrial": ~F.col("mito"), "only_mitochondrial": F.col("mito"),
    }
    slices = chado.organism_slices(filters, {"genus": "Dictyostelium", "species": "discoideum"})
    chado.export_slices(features, slices, str(tmp_path / "s"))
    got = spark.read.options(**CSV_READ).option("header", True).csv(str(tmp_path / "s"))
    assert {(r.folder, r.name, r.id) for r in got.collect()} == {
        ("purpureum", "purpureum_canonical_core", "1"), ("pallidum", "pallidum_canonical_core", "2"),
        ("pallidum", "pallidum_canonical_mitochondrial", "3"), ("fasciculatum", "fasciculatum_canonical_core", "5"),
        ("fasciculatum", "fasciculatum_canonical_mitochondrial", "4"), ("discoideum", "canonical_core", "6"),
    }


def test_class_and_alignment_slices(spark):
    from annexport.operators.slices import slice_export

    rows = [("noncanonical_curated", "dicty", "chromosome", "EST", None),
            (None, "dicty", "chromosome", "databank_entry", "nucleotide_match"),
            (None, "dicty", "chromosome", "databank_entry", "other"), ("x", "human", "chromosome", "EST", None)]
    df = spark.createDataFrame(rows, "class string, organism string, reference_type string, feature_type string, match_type string")
    columns = ("organism", "reference_type", "feature_type", "match_type")
    slices = chado.class_slices(F.col("class")) + chado.alignment_slices({c: F.col(c) for c in columns})
    got = slice_export(df, slices).select("name", "organism").collect()
    assert sorted(r.name for r in got) == ["EST", "databank_entry", "noncanonical_curated"]
    assert {r.organism for r in got} == {"dicty"}
    assert option_filter({}, {}) is None


def test_notes(spark, tmp_path):
    notes = spark.createDataFrame([(1, True), (2, False), (3, None)], "id long, private boolean")
    chado.export_notes(notes, F.col("private"), str(tmp_path / "n"))
    got = spark.read.option("header", True).csv(str(tmp_path / "n"))
    assert {(r.id, r.visibility) for r in got.collect()} == {("1", "private"), ("2", "public"), ("3", "private")}


class Changed:
    """A source in which some tables are not as they are."""

    empty_is_null = False

    def __init__(self, source, **changes):
        self.source, self.changes = source, changes

    def table(self, name):
        df = self.source.table(name)
        return self.changes[name](df) if name in self.changes else df


def without_accession(key):
    value = F.when(F.col("dbxref_id") != key, F.col("accession"))
    return lambda df: df.withColumn("accession", value)


def test_a_null_accession_is_no_silent_loss(source, tmp_path):
    ordered = Changed(source, dbxref=without_accession(1))
    with pytest.raises(RequiredValueError, match="stock_label"):
        chado.export_orders(ordered, str(tmp_path / "o"))
    with pytest.raises(RequiredValueError, match="accession"):
        chado.export_users(ordered, str(tmp_path / "p"), str(tmp_path / "s"))
    with pytest.raises(LookupMissError, match="with accession"):
        chado.export_strain_phenotypes(ordered, str(tmp_path / "x"))
    report = chado.export_strain_phenotypes(ordered, str(tmp_path / "x"), "report")
    assert {tuple(r) for r in report.collect()} == {("accession", 1), ("phenotype", 0), ("createdOn", 0)}
    # The second strain was never ordered.
    chado.export_orders(Changed(source, dbxref=without_accession(2)), str(tmp_path / "o"))


def test_strains_are_told_by_item_id_where_ids_repeat(source, tmp_path):
    """The first order's strains share the id of its plasmid, so they are none."""
    same = Changed(source, stock_item_order=lambda df: df.withColumn("stock_item_order_id", F.lit(1).cast("long")))
    chado.export_orders(same, str(tmp_path / "o"))
    assert "DBS1" not in text(tmp_path / "o")
    assert "a@x,pA\n" in text(tmp_path / "o")


def test_repeated_keys_of_unread_lookups_stop_the_export(spark, source, tmp_path):
    class Repeated:
        def table(self, name):
            rows = source.table(name)
            return rows.unionAll(rows) if name == "cvterm" else rows

    with pytest.raises(RequiredValueError, match="cvterm_id of cvterm"):
        chado.export_strain_phenotypes(Repeated(), str(tmp_path / "o"))
    chado.export_strain_phenotypes(source, str(tmp_path / "o"), on_violation="report")


def test_exports_read_no_more_than_the_listed_columns(spark, source, tmp_path):
    staged = StagedTables(source, chado.READ_COLUMNS)
    chado.export_orders(staged, str(tmp_path / "orders"))
    chado.export_users(staged, str(tmp_path / "plasmids"), str(tmp_path / "strains"))
    chado.export_strain_phenotypes(staged, str(tmp_path / "phenotypes"), on_violation="report")
    chado.export_gene_descriptions(staged, str(tmp_path / "genes"))
    chado.export_orders(source, str(tmp_path / "orders2"))
    assert text(str(tmp_path / "orders")) == text(str(tmp_path / "orders2")) != ""


def test_own_space_names_and_listed_tables(spark, source, tmp_path):
    catalog = frames_catalog(
        spark, {"a": spark.range(2), "b": spark.range(1)}, "O", tablespaces={"b": "USERS"}
    )
    chado.export_own_space_table_names(catalog, "O", str(tmp_path / "names"))
    assert text(str(tmp_path / "names")) == "a\n"
    (tmp_path / "list").write_text(" email \n\nno_such;\nemail\n")
    report = chado.export_listed_tables_json(
        spark, source, str(tmp_path / "list"), str(tmp_path / "json"), on_violation="report"
    )
    assert {(r.name, r.status) for r in report.collect()} == {("email", "done"), ("no_such", "failed")}
    assert text(str(tmp_path / "json/email.json")).count("\n") == 3


def executions(spark):
    return spark._jsparkSession.sharedState().statusStore().executionsCount()


def test_orders_read_the_items_once(spark, source, tmp_path):
    before = executions(spark)
    chado.export_orders(source, str(tmp_path / "o"))
    store = spark._jsparkSession.sharedState().statusStore()
    runs = store.executionsList()
    plans = [runs.apply(k).physicalPlanDescription() for k in range(runs.size()) if runs.apply(k).executionId() >= 0][before:]
    assert executions(spark) - before == len(plans) == 2  # the staging of the items, the writing
    # An adaptive plan is described as it began and as it ended.
    scans = [len(re.findall(r"Location: .*stock_item_order\.parquet", p)) / (1 + ("Initial Plan" in p)) for p in plans]
    assert sum(scans) == 1


def test_required_values_are_checked_by_the_job_that_writes(spark, source, tmp_path):
    before = executions(spark)
    chado.export_gene_descriptions(source, str(tmp_path / "g"))
    assert executions(spark) == before + 1
    chado.export_users(source, str(tmp_path / "p"), str(tmp_path / "s"))
    assert executions(spark) == before + 3


def test_a_violation_leaves_no_output_and_the_old_one_stays(spark, source, tmp_path):
    out = str(tmp_path / "g")
    chado.export_gene_descriptions(source, out)
    whole = text(out)
    broken = Changed(source, v_gene_features=lambda df: df.withColumn("uniquename", F.nullif("uniquename", F.lit("geneB"))))
    with pytest.raises(RequiredValueError, match="name: [0-9]+ NULL"):
        chado.export_gene_descriptions(broken, out)
    assert text(out) == whole != "" and [p.name for p in tmp_path.iterdir()] == ["g"]
    chado.export_gene_descriptions(broken, out, on_violation="report")
    assert text(out) != whole and [p.name for p in tmp_path.iterdir()] == ["g"]
    unsigned = Changed(source, stock_center=lambda df: df.withColumn("created_by", F.lit(None).cast("string")))
    with pytest.raises(RequiredValueError, match="created_by: 2 NULL"):
        chado.export_users(unsigned, str(tmp_path / "p"), str(tmp_path / "s"))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["g", "p"]


def test_small_slices_are_one_file_however_many_tasks_had_rows(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 200).select(
        "id", F.when(F.col("id") % 400 == 0, "noncanonical_curated").otherwise("canonical_noncoding").alias("c")
    )
    chado.export_slices(rows, chado.class_slices(F.col("c")), str(tmp_path / "s"))
    files = {p.name: len(glob.glob(f"{p}/part-*")) for p in (tmp_path / "s" / "folder=discoideum").iterdir()}
    assert files == {"name=noncanonical_curated": 1, "name=canonical_noncoding": 1}
    assert sorted(int(r[0]) for r in records(spark, str(tmp_path / "s"), True)) == list(range(4000))
    chado.export_notes(rows, F.col("id") % 7 == 0, str(tmp_path / "n"))
    assert {p.name: len(glob.glob(f"{p}/part-*")) for p in (tmp_path / "n").iterdir() if p.is_dir()} == {"visibility=private": 1, "visibility=public": 1}


def test_large_slices_are_cut_by_size(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 200).select("id", F.lit("noncanonical_curated").alias("c"), F.sha2(F.col("id").cast("string"), 512).alias("t"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        chado.export_slices(rows, chado.class_slices(F.col("c")), str(tmp_path / "s"))
    finally:
        spark.conf.set(key, before)
    assert 2 < len(glob.glob(f"{tmp_path}/s/folder=*/name=*/part-*")) < 40
