"""Strains with their observed phenotypes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annexport.functions.text import timestamp_text
from annexport.operators.membership import lookup_misses, strict_lookup


def unnamed_strains(strains: DataFrame, accessions: DataFrame) -> DataFrame:
    """``dbxref_id, row_count`` of the strains that have no accession."""
    return lookup_misses(strains.select("dbxref_id"), accessions, "dbxref_id", ["accession"])


def strain_phenotype(
    strains: DataFrame, accessions: DataFrame, statements: DataFrame,
    genotypes: DataFrame, phenotypes: DataFrame, terms: DataFrame,
    on_violation: str = "report",
) -> DataFrame:
    """``strain_ID, phenotype, createdOn``, one row per strain and statement about it.

    Inputs: strains (dbxref_id), accessions (dbxref_id, accession), statements (genotype_id,
    phenotype_id), genotypes (genotype_id, uniquename), phenotypes (phenotype_id,
    observable_id, timecreated), terms (cvterm_id, name). Every second column set starts with
    its key, so lookups that add no output column would change nothing and are not joined.

    A strain whose accession is missing or NULL is an error under ``fail``; with ``report`` it has
    no rows, as it has no statements, and ``unnamed_strains`` counts it. A statement without phenotype or term keeps NULL there.
    """
    named = strict_lookup(
        strains.select("dbxref_id"), accessions, "dbxref_id", on_violation, required=["accession"]
    )
    described = (
        statements.join(genotypes, "genotype_id")
        .join(phenotypes, "phenotype_id", "left")
        .join(
            terms.select(F.col("cvterm_id").alias("observable_id"), F.col("name").alias("phenotype")),
            "observable_id",
            "left",
        )
        .select(F.col("uniquename").alias("accession"), "phenotype", "timecreated")
    )
    return named.join(described, "accession").select(
        F.col("accession").alias("strain_ID"),
        "phenotype",
        timestamp_text(F.col("timecreated")).alias("createdOn"),
    )
