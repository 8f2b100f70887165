import csv
import glob
import json

import pytest
from pyspark.sql import functions as F

from annexport.operators import longtext
from annexport.operators.checks import (
    RequiredValueError,
    require_values,
    required_violations,
    unregistered,
)
from annexport.operators.longtext import TextTable
from annexport.plans.chado import export_long_text, export_registered_table, export_table_names
from annexport.plans.exports import DONE, FAILED, Export, ExportError, export_tables
from annexport.sinks.files import CSV_READ, write_csv, write_json
from annexport.sources.catalog import Catalog, frames_catalog, spark_catalog
from annexport.sources.rows import known_rows
from annexport.sources.tables import (
    OLD_SOURCES, FileTables, JdbcTables, balanced_ranges, id_ranges, quantile_bounds, quantiles_sql, range_predicates,
)

NASTY = [
    "plain", "", None, " lead", "trail ", "  both  ", "a,b", 'say "hi"', '"', '""', "two\nlines", "\n", "crlf\r\nin",
    "cr\rin", "\\", 'back\\"slash', "\\.", "#hash", "é漢😀", "\ttab\t", "'", "a\x0bb", ",", "ends\\", 'q",', "null",
]


def test_records_as_text(spark):
    record = spark.createDataFrame([(123, "test", 30)], "test_id int, test_name string, Age long")
    assert tuple(longtext.as_text(record).first()) == ("123", "test", "30")
    assert record.columns == ["test_id", "test_name", "Age"]
    ids = spark.sql("SELECT CAST(7 AS DECIMAL(38,10)) AS id, 'x' AS t")
    with pytest.raises(TypeError, match="id"):
        longtext.as_text(ids)
    assert tuple(longtext.as_text(longtext.whole_id(ids, "id")).first()) == ("7", "x")
    with pytest.raises(TypeError, match="Value"):
        longtext.as_text(spark.createDataFrame([(3.14,)], "Value double"))
    tagged = spark.createDataFrame([(1, "x")], "Field1 int, Field2 string")
    assert longtext.as_text(tagged, {"Field1": "custom_name"}).columns == ["custom_name", "Field2"]


def test_registry(spark):
    assert len(longtext.REGISTERED_TABLES) == 21
    assert longtext.registered_table("PUB") == TextTable("pub", ("TITLE", "VOLUMETITLE"), "PUB_ID")
    assert longtext.registered_table("plasmid").id_column == "ID"
    assert longtext.registered_table("Paragraph").id_column == "PARAGRAPH_NO"
    assert longtext.registered_table("chadologs").id_column == "CHADO_LOGS_ID"
    with pytest.raises(KeyError):
        longtext.registered_table("mv_gene_description")
    inventory = spark.createDataFrame([("PUB",), ("NEWTAB",)], "table_name string")
    assert [r.table_name for r in unregistered(inventory, longtext.registry_frame(spark)).collect()] == ["NEWTAB"]


def nasty(spark):
    rows = [(i, v, NASTY[(i * 7 + 3) % len(NASTY)]) for i, v in enumerate(NASTY)]
    return spark.createDataFrame(rows, "id long, a string, b string")


def test_csv_reads_back_whole(spark, tmp_path):
    df = nasty(spark)
    write_csv(df, str(tmp_path / "c"))
    back = spark.read.schema(df.schema).options(**CSV_READ).option("header", True).csv(str(tmp_path / "c"))
    expected = {(i, a or "", b or "") for i, a, b in df.collect()}
    assert {(r.id, r.a or "", r.b or "") for r in back.collect()} == expected
    seen = set()
    for part in glob.glob(f"{tmp_path}/c/part-*"):
        with open(part, newline="") as handle:
            rows = list(csv.reader(handle))
        assert rows[0] == ["id", "a", "b"]
        seen |= {(int(i), a, b) for i, a, b in rows[1:]}
    assert seen == expected


def test_any_text_filter_and_empty_is_null(spark):
    spec = TextTable("t", ("a", "b"), "id")
    df = spark.createDataFrame([(1, None, "x"), (2, None, None), (3, "", None)], "id long, a string, b string")
    assert [r.id for r in longtext.text_columns_export(df, spec).collect()] == [1, 3]
    assert [r.id for r in longtext.text_columns_export(df, spec, empty_is_null=True).collect()] == [1]
    assert [tuple(r) for r in longtext.as_text(df).collect()] == [("1", "", "x"), ("2", "", ""), ("3", "", "")]


def test_json_keeps_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "a\n\"b\"")], "id long, t string")
    write_json(df, str(tmp_path / "j"))
    lines = [json.loads(v) for p in glob.glob(f"{tmp_path}/j/part-*") for v in open(p)]
    assert sorted(lines, key=lambda r: r["id"]) == [{"id": 1, "t": None}, {"id": 2, "t": "a\n\"b\""}]
    objects = [json.loads(r.json) for r in longtext.table_json(df).collect()]
    assert sorted(objects, key=lambda r: r["id"]) == sorted(lines, key=lambda r: r["id"])


def catalog(spark):
    owner = "STOCKS"
    return Catalog(
        known_rows(
            spark,
            [
                (owner, "PUB", owner, "N", 5), (owner, "FEATURE", owner, "N", 3), (owner, "CV", owner, "N", 0),
                (owner, "CVTERM", owner, "N", None), (owner, "CHADOPROP", owner, "N", 9),
                (owner, "MV_X", owner, "N", 4), (owner, "TMP", owner, "Y", 1), (owner, "FAR", "USERS", "N", 1),
                ("OTHER", "PUB", "OTHER", "N", 5), (owner, "MV_O", owner, "N", 2),
            ],
            "owner string, table_name string, tablespace_name string, temporary string, num_rows long",
        ),
        known_rows(
            spark,
            [
                (owner, "PUB", "VOLUMETITLE", "CLOB"), (owner, "PUB", "TITLE", "CLOB"), (owner, "PUB", "PUB_ID", "NUMBER"),
                (owner, "FEATURE", "RESIDUES", "CLOB"), (owner, "CV", "DEFINITION", "CLOB"),
                (owner, "CVTERM", "DEFINITION", "CLOB"), (owner, "CHADOPROP", "VALUE", "CLOB"),
                (owner, "MV_X", "T", "CLOB"), ("OTHER", "PUB", "TITLE", "CLOB"), (owner, "GONE", "T", "CLOB"),
                (owner, "MV_O", "T", "CLOB"),
            ],
            "owner string, table_name string, column_name string, data_type string",
        ),
        known_rows(spark, [(owner, "MV_X"), ("OTHER", "MV_O")], "owner string, mview_name string"),
    )


def test_populated_columns_of_a_catalog(spark):
    got = longtext.populated_text_columns(catalog(spark), "STOCKS")
    assert {tuple(r) for r in got.collect()} == {
        ("PUB", "TITLE"), ("PUB", "VOLUMETITLE"), ("FEATURE", "RESIDUES"), ("MV_O", "T"),
    }
    specs = {r.table_name: r for r in longtext.text_export_specs(got).collect()}
    assert specs["PUB"].columns == ["TITLE", "VOLUMETITLE"]
    assert (specs["PUB"].id_column, specs["PUB"].output_file) == ("PUB_ID", "pub_clob_data.csv")


def test_table_names(spark, tmp_path):
    names = {r.table_name for r in longtext.table_names(catalog(spark), "STOCKS").collect()}
    assert names == {"PUB", "FEATURE", "CV", "CVTERM", "CHADOPROP", "FAR", "MV_O"}
    own = {r.table_name for r in longtext.own_space_table_names(catalog(spark), "STOCKS").collect()}
    assert own == {"PUB", "FEATURE", "CV", "CVTERM", "CHADOPROP", "TMP", "MV_X", "MV_O"}
    export_table_names(catalog(spark), "STOCKS", str(tmp_path / "names"))
    assert {r.value for r in spark.read.text(str(tmp_path / "names")).collect()} == names


def test_long_text_of_catalogued_tables(spark, tmp_path):
    root, out = str(tmp_path / "db"), str(tmp_path / "out")
    spark.createDataFrame(
        [(1, "t,1", None, 7), (2, None, None, 7), (3, "", "v\nv", 7), (4, "", "", 7)],
        "PUB_ID long, TITLE string, VOLUMETITLE string, PYEAR long",
    ).withColumn("PUB_ID", F.col("PUB_ID").cast("decimal(38,10)")).write.parquet(f"{root}/PUB.parquet")
    spark.createDataFrame([(9, "ACGT")], "FEATURE_ID long, RESIDUES string").write.parquet(f"{root}/FEATURE.parquet")
    source, cat = FileTables(spark, root, empty_is_null=True), catalog(spark)
    with pytest.raises(KeyError, match="MV_O"):
        export_long_text(spark, source, cat, "STOCKS", out)
    known = Catalog(cat.tables.where("table_name <> 'MV_O'"), cat.columns, cat.views)
    export_registered_table(source, "PUB", out + "/one")
    report = export_long_text(spark, source, known, "STOCKS", out)
    assert {tuple(r)[:3] for r in report.collect()} == {("PUB", DONE, 2), ("FEATURE", DONE, 1)}
    for folder in ("pub_clob_data.csv", "one"):
        back = spark.read.options(**CSV_READ).option("header", True).csv(f"{out}/{folder}")
        assert back.columns == ["PUB_ID", "TITLE", "VOLUMETITLE"]
        assert {(r.PUB_ID, r.TITLE or "", r.VOLUMETITLE or "") for r in back.collect()} == {("1", "t,1", ""), ("3", "", "v\nv")}


def test_one_failed_export_does_not_stop_the_others(spark, tmp_path):
    good, empty = spark.range(5), spark.range(0)
    exports = [
        Export("good", lambda: good, write_json, str(tmp_path / "good")),
        Export("empty", lambda: empty, write_json, str(tmp_path / "empty")),
        Export("bad", lambda: spark.read.parquet(str(tmp_path / "none")), write_json, str(tmp_path / "bad")),
        Export("late", lambda: good.select(F.raise_error(F.lit("boom")).alias("x")), write_json, str(tmp_path / "late")),
    ]
    report = {r.name: r for r in export_tables(spark, exports, on_violation="report").collect()}
    assert (report["good"].status, report["good"].row_count) == (DONE, 5)
    assert (report["empty"].status, report["empty"].row_count) == (DONE, 0)
    assert report["bad"].status == report["late"].status == FAILED
    assert report["bad"].error and report["bad"].row_count is None
    with pytest.raises(ExportError, match="bad"):
        export_tables(spark, exports)
    assert spark.read.json(str(tmp_path / "good")).count() == 5


def test_required_values(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a long, b string")
    assert {tuple(r) for r in required_violations(df, ["a", "b"]).collect()} == {("a", 1), ("b", 2)}
    with pytest.raises(RequiredValueError, match="b: 2 NULL"):
        require_values(df, ["a", "b"])
    assert require_values(df, ["a", "b"], "report").count() == 3
    assert require_values(df.where("a = 3"), ["a", "b"]).count() == 1


def test_statistics_of_empty_and_textless_tables(spark):
    frames = {
        "e": spark.createDataFrame([], "id long, t string"),
        "n": spark.createDataFrame([(1,)], "id long"),
        "t": spark.createDataFrame([(1, "abc", None), (2, None, None)], "id long, t string, u string"),
    }
    views = known_rows(spark, [], "mview_name string")
    assert {tuple(r) for r in longtext.column_statistics(frames).collect()} == {
        ("e", "t", 0, 0), ("t", "t", 1, 3), ("t", "u", 0, 0),
    }
    assert {tuple(r) for r in longtext.text_column_inventory(frames, views, ()).collect()} == {
        ("t", "t", 1, 3, "t_clob_data.csv"),
    }


def test_id_ranges_cover_all_rows(spark):
    df = spark.range(5, 1005)
    rows = id_ranges(df, "id", 7).orderBy("id_range").collect()
    assert len(rows) == 7 and sum(r.row_count for r in rows) == 1000
    assert all(a.highest_id < b.lowest_id for a, b in zip(rows, rows[1:]))
    assert id_ranges(spark.range(0), "id", 4).collect() == []


def test_jdbc_read_options(spark):
    source = JdbcTables(
        spark, "jdbc:oracle:thin:@//db:1521/svc", owner="STOCKS", partitions=32,
        id_columns={"PLASMID": "ID"}, schemas={"PLASMID": "ID BIGINT"}, options={"user": "u", "password": "secret"},
    )
    assert "secret" not in repr(source)
    options = source.read_options("PLASMID", (10, 99))
    assert options["dbtable"] == "STOCKS.PLASMID"
    assert options["customSchema"] == "ID BIGINT"
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("ID", "10", "100", "32")
    assert "MIN(ID)" in source.bounds_options("PLASMID")["dbtable"]
    assert "partitionColumn" not in source.read_options("OTHER.TABLE", None)
    assert source.read_options("OTHER.TABLE")["dbtable"] == "OTHER.TABLE"


def test_jdbc_reads_no_large_table_in_one_task(spark):
    source = JdbcTables(spark, "jdbc:none", id_columns={"t": "ID"}, partitions=8, rows_per_task=1000)
    assert (source.range_count(10), source.range_count(1_000_001)) == (8, 1001)
    with pytest.raises(ValueError, match="no id column"):
        source.table("other")


def test_empty_texts_of_files_are_kept(spark, tmp_path):
    rows = spark.createDataFrame([(1, "", None), (2, None, None), (3, "t", "v")], "PUB_ID long, TITLE string, VOLUMETITLE string")
    rows.write.parquet(str(tmp_path / "PUB.parquet"))
    export_registered_table(FileTables(spark, str(tmp_path)), "PUB", str(tmp_path / "kept"))
    export_registered_table(FileTables(spark, str(tmp_path), empty_is_null=True), "PUB", str(tmp_path / "few"))
    ids = lambda name: sorted(r.PUB_ID for r in spark.read.options(**CSV_READ).option("header", True).csv(str(tmp_path / name)).collect())
    assert (ids("kept"), ids("few")) == (["1", "3"], ["3"])


def test_id_ranges_of_large_ids_are_exact(spark):
    low = 2**60
    df = spark.range(low, low + 10)
    got = {r.id_range: (r.row_count, r.lowest_id) for r in id_ranges(df, "id", 5).collect()}
    assert got == {i: (2, low + 2 * i) for i in range(5)}


def skewed_ids(spark):
    """Dense at the low end, far apart at the high end, a few of them repeated or NULL."""
    low = spark.range(9000).select(F.col("id").alias("ID"))
    high = spark.range(1000).select((F.col("id") * 10**12 + 10**9).alias("ID"))
    return low.unionByName(high).unionByName(low.where("ID < 20")).unionByName(spark.sql("select cast(null as bigint) as ID"))


@pytest.mark.parametrize("rows_per_range", [100, 999, 10_020, 50_000])
def test_balanced_ranges_of_skewed_ids(spark, tmp_path, rows_per_range):
    """The query a database is asked, run on a view, gives the ids that the ranges are cut at."""
    skewed_ids(spark).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    table.createOrReplaceTempView("skewed_table")
    bounds = [r[0] for r in spark.sql(quantiles_sql("skewed_table", "ID", rows_per_range)).collect()]
    assert sorted(set(bounds)) == quantile_bounds(table, "ID", rows_per_range)
    counts = [table.where(p).count() for p in range_predicates("ID", bounds)]
    assert sum(counts) == table.count()
    assert max(counts) <= 2 * rows_per_range and len(counts) == 10_020 // rows_per_range + 1
    found = balanced_ranges(table, "ID", rows_per_range).orderBy("id_range").collect()
    assert [r.row_count for r in found] == [c for c in counts if c]


def test_range_predicates():
    assert range_predicates("ID", []) == ["1 = 1"]
    assert range_predicates("ID", [7, 3, 7]) == ["(ID <= 3 OR ID IS NULL)", "ID > 3 AND ID <= 7", "ID > 7"]


def test_jdbc_reads_balanced_ranges(spark, monkeypatch):
    """What Spark's reader is handed; the database is asked for the bounds alone."""
    source = JdbcTables(
        spark, "jdbc:none", owner="STOCKS", rows_per_task=1000, id_columns={"PLASMID": "ID"},
        schemas={"PLASMID": "ID BIGINT"}, options={"user": "u"},
    )
    assert source.quantiles_query("PLASMID") == quantiles_sql("STOCKS.PLASMID", "ID", 1000)
    asked = {}

    class Reader:
        def format(self, name):
            return self

        def options(self, **options):
            asked["bounds"] = options
            return self

        def load(self):
            return spark.createDataFrame([(5,), (9,)], "ID long")

        def jdbc(self, url, table, predicates, properties):
            asked.update(url=url, table=table, predicates=predicates, properties=properties)
            return spark.createDataFrame([], "ID long")

    monkeypatch.setattr(type(spark), "read", property(lambda self: Reader()))
    source.table("PLASMID")
    assert "ROW_NUMBER()" in asked["bounds"]["dbtable"] and asked["bounds"]["user"] == "u"
    assert (asked["url"], asked["table"]) == ("jdbc:none", "STOCKS.PLASMID")
    assert asked["predicates"] == range_predicates("ID", [5, 9])
    assert asked["properties"] == {"fetchsize": "200", "user": "u", "customSchema": "ID BIGINT"}


def test_catalog_of_spark_itself(spark):
    own = spark.newSession()
    frames = {
        "notes": own.createDataFrame([(1, "x")], "id long, body string"), "empty": own.createDataFrame([], "body string"),
        "numbers": own.range(3), "seen": own.createDataFrame([("y",)], "body string"),
    }
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    owner = own.catalog.currentDatabase()
    found = spark_catalog(own, views=["seen"])
    want = frames_catalog(own, frames, owner, views=["seen"], temporary=frames)
    for a, b in ((found.tables, want.tables), (found.columns, want.columns), (found.views, want.views)):
        assert sorted(map(tuple, a.select(*b.columns).collect())) == sorted(map(tuple, b.collect()))
    specs = lambda c: sorted(map(tuple, longtext.text_export_specs(longtext.populated_text_columns(c, owner)).collect()))
    assert specs(found) == specs(want) and [r[0] for r in specs(found)] == ["notes"]


def test_catalog_uses_gathered_statistics_and_stored_views(spark):
    spark.sql("create database if not exists catalog_test")
    try:
        spark.createDataFrame([(1, "x"), (2, "y")], "id long, body string").write.mode("overwrite").saveAsTable("catalog_test.analysed")
        spark.createDataFrame([(1, "x")], "id long, body string").write.mode("overwrite").saveAsTable("catalog_test.counted")
        spark.sql("analyze table catalog_test.analysed compute statistics")
        spark.sql("create or replace view catalog_test.seen as select body from catalog_test.analysed")
        found = spark_catalog(spark, "catalog_test")
        rows = {r.table_name: (r.num_rows, r.temporary) for r in found.tables.collect() if r.temporary == "N"}
        assert rows == {"analysed": (2, "N"), "counted": (1, "N"), "seen": (2, "N")}
        assert [r.mview_name for r in found.views.collect()] == ["seen"]
        columns = longtext.populated_text_columns(found, "catalog_test")
        assert {"analysed", "counted"} <= {r.table_name for r in columns.collect()} and "seen" not in {r.table_name for r in columns.collect()}
    finally:
        spark.sql("drop database catalog_test cascade")


def test_filled_columns_are_read_off_footers(spark, tmp_path):
    from tests.test_scale import plan

    rows = spark.createDataFrame([(1, "x", None, ""), (2, None, None, None)], "id long, body string, none string, empty string")
    rows.write.parquet(str(tmp_path / "notes.parquet"))
    rows.limit(0).write.parquet(str(tmp_path / "nothing.parquet"))
    rows.write.parquet(str(tmp_path / "seen.parquet"))
    rows.select("id").write.parquet(str(tmp_path / "numbers.parquet"))
    before = spark.conf.get(OLD_SOURCES)
    frames = FileTables(spark, str(tmp_path)).footer_frames(["notes", "nothing", "seen", "numbers"])
    assert spark.conf.get(OLD_SOURCES) == before
    views = known_rows(spark, [("seen",)], "mview_name string")
    found = longtext.filled_text_columns(frames, views)
    assert sorted(map(tuple, found.collect())) == [("notes", "body"), ("notes", "empty")]
    assert "PushedAggregation: [COUNT(body), COUNT(none), COUNT(empty)]" in plan(found, "formatted")
    counted = frames_catalog(spark, frames, "own").tables
    assert {r.table_name: r.num_rows for r in counted.collect()} == {"notes": 2, "nothing": 0, "seen": 2, "numbers": 2}
    assert plan(counted, "formatted").count("PushedAggregation: [COUNT(*)]") >= 4


def test_catalog_queries_read_no_rows(spark):
    from annexport.plans.queries import QUERIES, TABLES
    from tests.test_scale import plan

    for name in ("text_export_specs", "table_name_list", "text_export_specs_filled"):
        found = plan(QUERIES[name](spark, "/root/testdata/sf0.001"), "formatted")
        scans = found.count("Batched: ") or found.count("BatchScan")
        assert "PushedAggregation: []" not in found and found.count("PushedAggregation: [COUNT(") >= 5 and scans
