"""Entities with their free-text description."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annexport.functions.text import timestamp_text


def described_entities(
    entities: DataFrame, properties: DataFrame, terms: DataFrame, references: DataFrame,
    term_name: str = "description", ordered: bool = True,
) -> DataFrame:
    """``name, accession, description, createdOn, createdBy`` in order of creation.

    Inputs: entities (feature_id, uniquename, dbxref_id), properties (feature_id, type_id,
    value, timecreated, created_by, and a unique featureprop_id that settles ties), terms
    (cvterm_id, name), references (dbxref_id, accession). Term names may repeat: every term of
    that name counts. Rows without a time come last.
    """
    wanted = terms.where(F.col("name") == term_name).select(F.col("cvterm_id").alias("type_id"))
    rows = (
        properties.join(wanted, "type_id")
        .join(entities, "feature_id")
        .join(references, "dbxref_id")
    )
    if ordered:
        rows = rows.orderBy(F.col("timecreated").asc_nulls_last(), "featureprop_id")
    return rows.select(
        F.col("uniquename").alias("name"),
        "accession",
        F.col("value").alias("description"),
        timestamp_text(F.col("timecreated")).alias("createdOn"),
        F.col("created_by").alias("createdBy"),
    )
