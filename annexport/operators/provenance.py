"""Who made and changed an entity, and when."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annexport.functions.text import timestamp_text


def entity_provenance(entities: DataFrame, entity_id: Column) -> DataFrame:
    """``entity_id, created_by, date_created, date_modified`` with times as text."""
    return entities.select(
        entity_id.alias("entity_id"),
        "created_by",
        timestamp_text(F.col("date_created")).alias("date_created"),
        timestamp_text(F.col("date_modified")).alias("date_modified"),
    )


def accession_provenance(entities: DataFrame, accessions: DataFrame, on: str) -> DataFrame:
    """The same for entities whose id is the accession of a reference they point to."""
    return entity_provenance(entities.join(accessions, on), F.col("accession"))
