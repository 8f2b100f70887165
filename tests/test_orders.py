import random
from datetime import datetime

import pytest

from annexport.operators.membership import (
    LookupMissError,
    is_unique,
    lookup_misses,
    not_exists,
    not_in,
    strict_lookup,
)
from annexport.operators.orders import (
    flagged_order_items,
    labels_by_id,
    manifest_csv,
    manifest_lines,
    order_labels,
    order_manifest,
    unlabelled_stocks,
)


def test_manifest_of_hand_made_orders(spark):
    contacts = spark.createDataFrame(
        [
            (1, datetime(2020, 1, 2, 3, 4, 5), "a@x"), (1, datetime(2020, 1, 2, 3, 4, 5), "b@x"),
            (2, datetime(2020, 1, 1), "c@x"), (3, datetime(2021, 1, 1), "d@x"),
        ],
        "order_id long, order_date timestamp_ntz, contact string",
    )
    items = spark.createDataFrame(
        [
            (1, "pA", 10), (1, "pA", 10), (1, "strain", 11), (1, "strain2", 10),
            (2, "nothing", 99), (3, "p,B", 11), (3, None, 11), (3, "pA", None),
        ],
        "order_id long, item string, item_id long",
    )
    catalog = spark.createDataFrame([("pA", "pA"), ("p,B", "p,B"), ("p,B", "p,B")], "item string, catalog_label string")
    stocks = spark.createDataFrame([(10, "DBS10"), (11, "DBS11")], "item_id long, stock_label string")
    manifest = order_manifest(contacts, items, catalog, stocks, "item", "item_id")
    lines = manifest_csv(manifest).orderBy("order_id", "contact")
    assert [r.line for r in lines.collect()] == [
        "2020-01-02 03:04:05,a@x,pA,DBS10,DBS11",
        "2020-01-02 03:04:05,b@x,pA,DBS10,DBS11",
        "2020-01-01 00:00:00,c@x",
        '2021-01-01 00:00:00,d@x,"p,B",pA,DBS11',
    ]


def test_an_order_of_any_size_is_one_sorted_line(spark):
    rows = spark.range(200_000).selectExpr("1L AS order_id", "id % 3 = 0 AS is_catalog", "concat('label', id) AS label")
    few = spark.createDataFrame([(2, False, "b"), (2, True, "c"), (2, False, "a")], rows.schema)
    got = {r.order_id: r["items"] for r in manifest_lines(rows.unionByName(few)).collect()}
    assert got[2] == ["c", "a", "b"]
    names = [f"label{i}" for i in range(200_000)]
    assert got[1] == sorted(names[::3]) + sorted(n for i, n in enumerate(names) if i % 3)


def sql_not_in(value, values):
    if not values:
        return True
    if value is None or None in values:
        return False
    return value not in values


@pytest.mark.parametrize("nulls", [0.0, 0.2])
def test_not_in_follows_sql_rules(spark, nulls):
    rng = random.Random(int(nulls * 10) + 2)

    def rows(n):
        return [
            (rng.choice([None, *range(30)]), None if rng.random() < nulls else rng.randrange(6), i)
            for i in range(n)
        ]

    left, right = rows(400), rows(80)
    schema = "g long, v long, n long"
    got = not_in(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), "v", ["g"])
    expected = [
        r for r in left
        if sql_not_in(r[1], [x[1] for x in right if x[0] is not None and x[0] == r[0]])
    ]
    assert sorted(r.n for r in got.collect()) == sorted(r[2] for r in expected)


def test_not_in_of_required_columns_needs_no_null_flags(spark):
    left, right = spark.range(10).withColumnRenamed("id", "v"), spark.range(3, 5).withColumnRenamed("id", "v")
    got = not_in(left, right, "v")
    assert sorted(r.v for r in got.collect()) == [0, 1, 2, 5, 6, 7, 8, 9]
    assert "Subquery" not in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("values", [[], [1, 2], [1, None], [None]])
def test_uncorrelated_not_in(spark, values):
    left = [(None,), (1,), (3,), (3,)]
    got = not_in(
        spark.createDataFrame(left, "v long"), spark.createDataFrame([(v,) for v in values], "v long"), "v"
    ).collect()
    key = lambda v: (v is None, v or 0)
    assert sorted((r.v for r in got), key=key) == sorted((v for (v,) in left if sql_not_in(v, values)), key=key)


def test_not_exists_keeps_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "x long, y string")
    right = spark.createDataFrame([(1, "a"), (1, None)], "x long, y string")
    assert {tuple(r) for r in not_exists(left, right, ["x", "y"]).collect()} == {(1, None), (2, "b")}


def test_lookups(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k long")
    lookup = spark.createDataFrame([(2, "two")], "k long, name string")
    assert {tuple(r) for r in lookup_misses(rows, lookup, "k").collect()} == {(1, 2), (None, 1)}
    with pytest.raises(LookupMissError):
        strict_lookup(rows, lookup, "k")
    assert strict_lookup(rows, lookup, "k", "report").count() == 4
    assert strict_lookup(rows.where("k = 2"), lookup, "k").first().name == "two"


def test_is_unique(spark):
    assert is_unique(spark.createDataFrame([(1,), (2,)], "k long"), ["k"])
    for bad in ([(1,), (1,)], [(1,), (None,)]):
        assert not is_unique(spark.createDataFrame(bad, "k long"), ["k"])


@pytest.mark.parametrize("null_ids", [False, True])
def test_labels_by_id_in_one_aggregation(spark, null_ids):
    """The same as two anti joins, on random orders with repeated and NULL numbers; one order has a third of all rows."""
    rng = random.Random(null_ids)
    ids = [None] * null_ids + list(range(8))
    rows = [
        (rng.choice([0, rng.randrange(1, 60)]) if k % 3 else 0, rng.choice(ids), rng.choice([None, *"abcdefgh"]), rng.choice([None, *range(12)]))
        for k in range(1500)
    ]
    items = spark.createDataFrame(rows, "order_id long, item_no long, item string, item_id long")
    catalog = spark.createDataFrame([(c, c.upper()) for c in "abc"], "item string, catalog_label string")
    stocks = spark.createDataFrame([(i, f"S{i % 7}" if i else None) for i in range(9)], "item_id long, stock_label string")
    flagged = flagged_order_items(items, catalog, stocks, "item", "item_id", "item_no")
    want = order_labels(items, catalog, stocks, "item", "item_id", "item_no")
    got = [tuple(r) for r in labels_by_id(flagged, null_ids).collect()]
    assert sorted(got) == sorted(map(tuple, want.collect())) and len(set(got)) == len(got)
    unlabelled = sum(r[2] not in ("a", "b", "c") and r[3] == 0 for r in rows)
    assert flagged.where(unlabelled_stocks()).count() == unlabelled


@pytest.mark.parametrize("by_id", [False, True])
def test_labels_by_flag_and_by_id(spark, by_id):
    """The second item shares its number with a catalog item of its order; the fourth has none."""
    items = spark.createDataFrame(
        [(1, 1, "p", 10), (1, 1, "s", 10), (1, 2, "s", 11), (1, None, "s", 12), (2, None, "s", 12), (2, 1, "s", 10)],
        "order_id long, item_no long, item string, item_id long",
    )
    catalog = spark.createDataFrame([("p", "p"), ("p", "p")], "item string, catalog_label string")
    stocks = spark.createDataFrame([(i, f"S{i}") for i in (10, 11, 12)], "item_id long, stock_label string")
    got = order_labels(items, catalog, stocks, "item", "item_id", "item_no" if by_id else None)
    always = [(1, False, "S11"), (1, True, "p"), (2, False, "S10"), (2, False, "S12")]
    by_flag = [(1, False, "S10"), (1, False, "S12")]
    assert sorted(tuple(r) for r in got.collect()) == sorted(always + ([] if by_id else by_flag))


def test_lookup_entries_without_a_required_value_are_misses(spark):
    rows = spark.createDataFrame([(1,), (2,), (2,)], "k long")
    lookup = spark.createDataFrame([(1, "one"), (2, None)], "k long, name string")
    assert {tuple(r) for r in lookup_misses(rows, lookup, "k", ["name"]).collect()} == {(2, 2)}
    assert lookup_misses(rows, lookup, "k").isEmpty()
    with pytest.raises(LookupMissError, match="with name"):
        strict_lookup(rows, lookup, "k", required=["name"])
