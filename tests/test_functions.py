import csv
import io
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from annexport.functions.csv import csv_line
from annexport.functions.text import (
    clean_name,
    export_file_name,
    normalise_lines,
    prefixed_id,
    split_file_name,
    timestamp_text,
)


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_csv_line_quotes_only_where_needed(spark):
    rows = [(["a", "b c", None, ""],), (["x,y", 'say "hi"', "two\nlines", "cr\rhere"],),
            ([" lead", "trail ", "\\.", "\ttab"],), (["é", "plain"],)]
    got = [r[0] for r in values(spark, rows, "f array<string>", csv_line(F.col("f")))]
    assert got == [
        "a,b c,,",
        '"x,y","say ""hi""","two\nlines","cr\rhere"',
        '" lead",trail ,"\\.","\ttab"',
        "é,plain",
    ]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.text(alphabet=' ,"\r\n\\.aé', max_size=6), min_size=2, max_size=5), min_size=1, max_size=20))
def test_csv_line_is_read_back_whole(spark, records):
    got = values(spark, [(r,) for r in records], "f array<string>", csv_line(F.col("f")))
    assert [next(csv.reader(io.StringIO(line, newline=""), strict=True)) for (line,) in got] == records


def test_prefixed_id_keeps_long_ids(spark):
    got = values(spark, [(1,), (9_999_999,), (12_345_678,), (None,)], "id long", prefixed_id(F.col("id"), "DBP", 7))
    assert [r[0] for r in got] == ["DBP0000001", "DBP9999999", "DBP12345678", None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_zoneless_time_is_printed_as_it_stands(spark, zone):
    # 02:30 on this day does not exist in New York.
    rows = [(datetime(2024, 3, 10, 2, 30, 5, 999999),), (None,)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = values(spark, rows, "t timestamp_ntz", timestamp_text(F.col("t")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r[0] for r in got] == ["2024-03-10 02:30:05", None]


def test_normalise_lines(spark):
    rows = [("a\r\nb\rc\n",), ("a\n\n",), ("a",), ("",), ("\r\n",), ("a\r\n\r\nb",), (None,)]
    got = [r[0] for r in values(spark, rows, "t string", normalise_lines(F.col("t")))]
    assert got == ["a\nb\nc", "a\n", "a", "", "", "a\n\nb", None]


def test_names(spark):
    rows = [(" STO-CKS.plasmid; ", "FeatureProp", "/data/in/a.b.gff3"), ("--", "X", "plain")]
    got = values(
        spark, rows, "n string, t string, p string", clean_name(F.col("n")),
        export_file_name(F.col("t")), split_file_name(F.col("p"), "_poly"),
    )
    assert got == [("STOCKSplasmid", "featureprop_clob_data.csv", "a_poly.gff3"), ("", "x_clob_data.csv", "plain_poly.gff3")]
