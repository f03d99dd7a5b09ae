"""Enrichment: index with normalized types, and edges from functions to types."""

from __future__ import annotations

from pyspark.sql import DataFrame

from graphloom.operators import enrich as op


def enrich(entities: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(index, all edges with the new ones) of entities with ``parameters``, ``return_value`` and ``source_file``."""
    return op.typed_index(entities), op.enriched(entities, edges)
