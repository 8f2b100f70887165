"""Curation exports as Spark jobs: order manifests, provenance, phenotypes, long text, GFF3."""
