"""Stock orders: contacts, ordered items, and one manifest per order and contact.

Columns are named after the order tables: ``order_id``, ``order_date``, ``contact``; an item
row has ``order_id``, the item's key and, after flagging, ``is_catalog``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annexport.functions.csv import csv_line
from annexport.functions.text import timestamp_text
from annexport.operators.membership import not_in


def order_contacts(
    orders: DataFrame, links: Sequence[tuple[DataFrame, str]], sort: Sequence[str] = ()
) -> DataFrame:
    """Inner join along a chain of tables; an order repeats for each contact reached.

    ``sort`` should end in a unique column: equal sort keys cannot be spread over tasks.
    """
    for link, on in links:
        orders = orders.join(link, on)
    return orders.orderBy(*sort) if sort else orders


def flag_items(items: DataFrame, catalog: DataFrame, on: str) -> DataFrame:
    """Item rows with ``is_catalog`` and the catalog's other columns (NULL where not listed)."""
    listed = catalog.distinct().withColumn("_listed", F.lit(True))
    return (
        items.join(listed, on, "left")
        .withColumn("is_catalog", F.coalesce("_listed", F.lit(False)))
        .drop("_listed")
    )


def order_catalog_items(
    items: DataFrame, catalog: DataFrame, on: str, columns: Sequence[str]
) -> DataFrame:
    """Distinct catalog items of each order. The catalog only decides membership."""
    return items.join(catalog.select(on), on, "left_semi").select(*columns).distinct()


def listed_ids(items: DataFrame, catalog: DataFrame, on: str, item_id: str) -> DataFrame:
    """``order_id`` and ids of the catalog items, each once."""
    return items.join(catalog.select(on), on, "left_semi").select("order_id", item_id).distinct()


def order_other_items(
    items: DataFrame, catalog: DataFrame, stocks: DataFrame, on: str, stock_on: str,
    columns: Sequence[str], item_id: str | None = None, listed: DataFrame | None = None,
) -> DataFrame:
    """Distinct stock labels of the items that are not in the catalog.

    With ``item_id`` an item goes when its id is among the ids of the catalog items of the same
    order, NULL ids following SQL's ``NOT IN``. Without it the caller states that item ids are
    unique and not NULL, and then an item goes exactly when it is itself in the catalog.

    ``listed`` is ``listed_ids``, which is asked twice: for ids, and for NULLs by order. Staged before,
    it needs the items only once.
    """
    if item_id is None:
        others = items.join(catalog.select(on), on, "left_anti")
    else:
        listed = listed_ids(items, catalog, on, item_id) if listed is None else listed
        others = not_in(items, listed, item_id, within=["order_id"])
    return others.join(stocks, stock_on).select(*columns).distinct()


def order_labels(
    items: DataFrame, catalog: DataFrame, stocks: DataFrame, on: str, stock_on: str,
    item_id: str | None = None, listed: DataFrame | None = None,
) -> DataFrame:
    """Distinct ``order_id, is_catalog, label``.

    ``catalog`` is (``on``, ``catalog_label``) and ``stocks`` (``stock_on``, ``stock_label``).
    Items in neither are left out. The distinct hashes the label too, so the rows of one huge
    order are combined by many tasks before the order is ever put together. For ``item_id`` and
    ``listed`` see ``order_other_items``; without it both kinds come from one pass over the items.
    """
    if item_id is not None:
        labelled = items.join(catalog.distinct(), on).select(
            "order_id", F.lit(True).alias("is_catalog"), F.col("catalog_label").alias("label")
        )
        others = order_other_items(
            items, catalog, stocks, on, stock_on, ["order_id", "stock_label"], item_id, listed
        ).select("order_id", F.lit(False).alias("is_catalog"), F.col("stock_label").alias("label"))
        return labelled.distinct().unionByName(others).where(F.col("label").isNotNull())
    flagged = flag_items(items, catalog, on).join(stocks, stock_on, "left")
    label = F.when(F.col("is_catalog"), F.col("catalog_label")).otherwise(F.col("stock_label"))
    return (
        flagged.select("order_id", "is_catalog", label.alias("label"))
        .where(F.col("label").isNotNull())
        .distinct()
    )


def flagged_order_items(
    items: DataFrame, catalog: DataFrame, stocks: DataFrame, on: str, stock_on: str, item_id: str
) -> DataFrame:
    """``order_id, item_id, is_catalog, label, has_stock`` of every item: all that its manifest and its checks need.

    Staged, it is the only thing that reads the items, and it is narrow. Inputs are those of ``order_labels``.
    """
    found = flag_items(items, catalog, on).join(stocks.withColumn("_found", F.lit(True)), stock_on, "left")
    label = F.when(F.col("is_catalog"), F.col("catalog_label")).otherwise(F.col("stock_label"))
    return found.select(
        "order_id", F.col(item_id).alias("item_id"), "is_catalog", label.alias("label"),
        F.coalesce("_found", F.lit(False)).alias("has_stock"),
    )


def unlabelled_stocks() -> Column:
    """Of ``flagged_order_items``: an ordered stock whose entry has no label."""
    return ~F.col("is_catalog") & F.col("has_stock") & F.col("label").isNull()


def labels_by_id(flagged: DataFrame, null_ids: bool = True) -> DataFrame:
    """``order_labels`` by item id, from ``flagged_order_items``.

    One aggregation by order and id says which ids are in the catalog and holds the labels of the others. An order's NULL
    rules (``NOT IN``) need a second, to one or two flags an order; ``null_ids=False`` states that no id is NULL.
    """
    other = F.when(~F.col("is_catalog"), F.col("label"))
    pairs = flagged.groupBy("order_id", "item_id").agg(
        F.bool_or("is_catalog").alias("listed"), F.collect_set(other).alias("labels")
    )
    others = pairs.where(~F.col("listed"))
    if null_ids:
        flags = flagged.where("is_catalog").select(
            F.col("order_id").alias("_order"), F.col("item_id").isNull().alias("_is_null")
        ).distinct()
        bad = F.col("_is_null") | F.col("item_id").isNull()
        others = others.join(flags, (F.col("order_id") == F.col("_order")) & bad, "left_anti")
    others = others.select("order_id", F.lit(False).alias("is_catalog"), F.explode("labels").alias("label"))
    listed = flagged.where("is_catalog").where("label is not null").select("order_id", "is_catalog", "label")
    return listed.distinct().unionByName(others.distinct())


def manifest_lines(labels: DataFrame) -> DataFrame:
    """``order_id, items``: one line per order, catalog labels first, then the others, each sorted.

    Labels are shuffled as plain rows: collecting on the map side first would only add to the
    volume, because they are distinct by now. A line is bounded by what one row may hold; readers
    of orders beyond that take ``manifest_items``.
    """
    return labels.repartition("order_id").groupBy("order_id").agg(_sorted_items())


def _sorted_items():
    """Catalog labels first, then the others, each in order."""
    other = (~F.col("is_catalog")).alias("other")
    ordered = F.sort_array(F.collect_list(F.struct(other, "label")))
    return ordered.getField("label").alias("items")


def order_manifest(
    contacts: DataFrame, items: DataFrame, catalog: DataFrame, stocks: DataFrame,
    on: str, stock_on: str, item_id: str | None = None, listed: DataFrame | None = None,
) -> DataFrame:
    """``order_id, order_date, contact, items`` for every order and contact.

    Orders without items are kept with an empty list. The dictionaries are to have one label
    per key.
    """
    return manifest_of(contacts, order_labels(items, catalog, stocks, on, stock_on, item_id, listed))


def manifest_of(contacts: DataFrame, labels: DataFrame) -> DataFrame:
    """``order_manifest`` of the labels of ``order_labels``."""
    lines = manifest_lines(labels)
    return contacts.join(lines, "order_id", "left").select(
        "order_id",
        timestamp_text(F.col("order_date")).alias("order_date"),
        "contact",
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def manifest_items(
    contacts: DataFrame, items: DataFrame, catalog: DataFrame, stocks: DataFrame,
    on: str, stock_on: str, item_id: str | None = None,
) -> DataFrame:
    """The manifest's long form: ``order_id, order_date, contact, is_catalog, label``, a row per label.

    Nothing is gathered by order, so its rows stay narrow whatever an order holds. Orders without items
    have one row without a label.
    """
    labels = order_labels(items, catalog, stocks, on, stock_on, item_id)
    return contacts.join(labels, "order_id", "left").select(
        "order_id", timestamp_text(F.col("order_date")).alias("order_date"), "contact", "is_catalog", "label"
    )


def manifest_csv(manifest: DataFrame) -> DataFrame:
    """One ``date,contact,item,item...`` line per manifest row; widths differ."""
    record = F.concat(F.array("order_date", "contact"), F.col("items"))
    return manifest.withColumn("line", csv_line(record))
