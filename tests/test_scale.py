"""How queries run: what is shuffled, read and broadcast, and what hot keys do to them."""

import contextlib
import io
import re
from contextlib import redirect_stdout

import pytest

from annexport.plans.queries import QUERIES, TABLES
from tests.compare import connect, oracle_result, spark_result

SF_DIR = "/root/testdata/sf0.01"
SMALL_DIR = "/root/testdata/sf0.001"

# Row-by-row work: nothing may be shuffled.
NARROW = ("table_name_clean", "gff3_lines", "dbxref_clean", "slice_export", "slice_export_optional")


@contextlib.contextmanager
def settings(spark, **values):
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def plan(df, mode="simple"):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def initial_plan(df):
    return plan(df).split("== Initial Plan ==")[-1]


@pytest.mark.parametrize("name", NARROW)
def test_narrow_queries_do_not_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "Exchange" not in text
    assert text.count("FileScan") == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_joins_and_no_forced_broadcast(spark, name):
    """With automatic broadcasts off, whatever is still broadcast would grow with the data."""
    with settings(spark, **NO_BROADCAST):
        text = plan(QUERIES[name](spark, SMALL_DIR))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BroadcastExchange|BroadcastHashJoin", text)
    assert not re.search("PythonUDF|ArrowEvalPython|BatchEvalPython|MapInPandas|Scan ExistingRDD", text)


def test_manifest_reads_each_table_once_and_only_what_it_needs(spark):
    text = initial_plan(QUERIES["order_manifest"](spark, SF_DIR))
    for table, columns in {
        "lineitem": "l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint",
        "orders": "o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz",
        "customer": "c_custkey:bigint,c_name:string",
        "supplier": "s_suppkey:bigint,s_name:string",
    }.items():
        scans = [v for v in text.splitlines() if f"/{table}.parquet" in v]
        assert len(scans) == 1
        assert f"ReadSchema: struct<{columns}>" in scans[0]
    part = [v for v in text.splitlines() if "/part.parquet" in v]
    assert len(part) == 1 and "LessThanOrEqual(p_size,25)" in part[0]
    # Distinct labels, and their orders; the join with the contacts uses the latter again.
    assert len(re.findall(r"Exchange hashpartitioning\(order_id#\d+L, is_catalog", text)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(order_id#\d+L, \d+\)", text)) == 2


def test_lookup_misses_counts_before_the_join(spark):
    with settings(spark, **NO_BROADCAST):
        text = initial_plan(QUERIES["lookup_misses"](spark, SF_DIR))
    assert text.count("Exchange hashpartitioning") == 2
    assert "partial_count" in text


HOT = {
    # A third of the rows of each table shares one key.
    "lineitem": "select case when row_number() over () % 3 = 0 then 1 else l_orderkey end as l_orderkey, "
    "case when row_number() over () % 3 = 1 then 7 else l_partkey end as l_partkey, "
    "case when row_number() over () % 3 = 2 then 3 else l_suppkey end as l_suppkey, "
    "l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate from base",
    "orders": "select * replace (case when o_orderkey % 3 = 0 then 5 else o_custkey end as o_custkey, "
    "case when o_orderkey % 3 = 0 then timestamp '1997-01-01' else o_orderdate end as o_orderdate) from base",
    "part": "select * replace (case when p_partkey % 3 = 0 then 'Brand#1' else p_brand end as p_brand) from base",
    "documents": "select * replace (case when doc_id % 3 = 0 then 'same' else text end as text) from base",
    "events": "select * replace (case when event_id % 3 = 0 then 0 else user_id end as user_id) from base",
}


@pytest.fixture(scope="module")
def hot_dir(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("hot"))
    con = connect(SMALL_DIR)
    for table in TABLES:
        query = HOT.get(table, "select * from base").replace("from base", f"from '{SMALL_DIR}/{table}.parquet'")
        con.execute(f"copy ({query}) to '{folder}/{table}.parquet' (format parquet)")
    return folder


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_hot_keys_without_broadcast_give_the_same_rows(spark, hot_dir, name):
    with settings(spark, **NO_BROADCAST):
        columns, rows = spark_result(spark, name, hot_dir)
    expected_columns, expected = oracle_result(connect(hot_dir), name)
    assert columns == expected_columns
    assert rows == expected


@pytest.mark.parametrize("name", ["order_manifest", "order_other_items_by_id", "strain_phenotype"])
def test_hot_join_partitions_are_split(spark, tmp_path, name):
    con = connect(SF_DIR)
    for table in TABLES:
        query = HOT.get(table, "select * from base").replace("from base", f"from '{SF_DIR}/{table}.parquet'")
        con.execute(
            f"copy ({query}) to '{tmp_path}/{table}.parquet' (format parquet, row_group_size 4096)"
        )
    skew = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.files.maxPartitionBytes": "64KB",
        "spark.sql.shuffle.partitions": "16",
    }
    with settings(spark, **NO_BROADCAST, **skew):
        df = QUERIES[name](spark, str(tmp_path))
        rows = df.collect()
        assert "skew=true" in plan(df).split("== Initial Plan ==")[0]
    assert len(rows) == len(oracle_result(connect(str(tmp_path)), name)[1])


def test_other_items_by_id_read_the_items_once_more_at_most(spark):
    plan = QUERIES["order_other_items_by_id"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet[^\n]*l_orderkey", plan)) == 1
