"""Queries of the general training-data operators: nested records (1) and orphan references (5)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from graphloom.operators import orphans, shred
from graphloom.session import small_batches, table


def _raw(op: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return op(table(spark, sf_dir, "raw_records"))

    return run


def _refs(op: Callable[..., DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: op(*(table(spark, sf_dir, t) for t in ("entities", "edges", "name_index", "source_docs")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per query; the first of each problem is the one that is compared."""
    return {
        "p1_found": _raw(shred.found),
        "p1_documents": _raw(lambda raw: shred.document_table(shred.shred(raw))),
        "p1_entities": _raw(lambda raw: shred.entity_table(shred.shred(raw))),
        "p1_children": _raw(lambda raw: shred.child_table(shred.shred(raw))),
        "p1_references": _raw(lambda raw: shred.reference_table(shred.shred(raw))),
        "p1_values": _raw(lambda raw: shred.value_table(shred.shred(raw))),
        "p1_malformed": _raw(shred.malformed),
        "p5_found": _refs(orphans.found),
        "p5_report": _refs(orphans.report),
    }


_ORPHANS = """
WITH refs AS (
    SELECT 'entities' AS table_name, rec_id AS row_id, 'cross_references' AS column_name, v AS ref_value, extracted_at AS t FROM (SELECT rec_id, extracted_at, unnest(cross_references) AS v FROM entities)
    UNION ALL SELECT 'entities', rec_id, 'document_id', document_id, extracted_at FROM entities
    UNION ALL SELECT 'edges', edge_id, 'target', target, created_at FROM edges
    UNION ALL SELECT 'edges', edge_id, 'rec_id', CAST(rec_id AS VARCHAR), created_at FROM edges),
there AS (
    SELECT 'name' AS kind, name AS k, indexed_at AS b, removed_at AS e FROM name_index
    UNION ALL SELECT 'document_id', document_id, registered_at, withdrawn_at FROM source_docs
    UNION ALL SELECT 'rec_id', CAST(rec_id AS VARCHAR), NULL, NULL FROM entities),
asked AS (SELECT DISTINCT *, CASE WHEN column_name IN ('cross_references', 'target') THEN 'name' ELSE column_name END AS kind FROM refs WHERE ref_value IS NOT NULL AND ref_value <> ''),
met AS (SELECT DISTINCT table_name, row_id, column_name, ref_value, t FROM asked JOIN there ON asked.kind = there.kind AND k = ref_value
    WHERE asked.kind = 'rec_id' OR (b <= t AND (e IS NULL OR e > t))),
orphans AS (SELECT a.table_name, a.row_id, a.column_name, a.ref_value, a.t FROM asked a
    LEFT JOIN met m ON a.table_name = m.table_name AND a.row_id = m.row_id AND a.column_name = m.column_name AND a.ref_value = m.ref_value AND a.t IS NOT DISTINCT FROM m.t WHERE m.row_id IS NULL)
"""


def oracle_sql() -> dict[str, str]:
    """DuckDB statements for the queries that SQL can express."""
    return {
        "p5_found": _ORPHANS + "SELECT DISTINCT table_name, row_id, column_name, ref_value FROM orphans",
        "p5_report": _ORPHANS
        + "SELECT table_name, column_name, strftime(t AT TIME ZONE 'UTC', '%Y-%m') AS month, count(*) AS orphans, count(DISTINCT ref_value) AS keys FROM orphans GROUP BY ALL",
    }
