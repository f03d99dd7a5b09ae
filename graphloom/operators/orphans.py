"""References to records that do not exist, or not at the time of the reference.

A broadcast Bloom filter over all parent keys proves most orphans at once; only references it lets through
are verified by an exact join against the periods in which their key existed.

Defined results. Null and empty references are no cases. A reference without a time is held against no period,
so it is an orphan. A period without a start never began. Repeated rows give one case per row key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.operators import bloom
from graphloom.operators.skew import hot_keys, left_join_unique

#: Parents of at most this many keys are broadcast for the exact check; larger ones are joined by shuffle.
BROADCAST_KEYS = 10_000
#: Row format of a reference.
REF = ("table_name", "row_id", "column_name", "ref_value", "at")


def refs_of(df: DataFrame, table_name: str, row_id: str, column_name: str, value: Column, at: Column | None) -> DataFrame:
    """References in REF format; ``value`` is an array or a single value."""
    at = F.lit(None).cast("timestamp") if at is None else at
    return df.select(
        F.lit(table_name).alias("table_name"), F.col(row_id).alias("row_id"), F.lit(column_name).alias("column_name"), value.cast("string").alias("ref_value"), at.alias("at")
    ).where("ref_value is not null and ref_value <> ''")


def periods(parents: DataFrame, key: str, begins: str | None = None, ends: str | None = None) -> DataFrame:
    """One row per key with the distinct periods in which it existed; without ``begins``, for all time."""
    if begins is None:
        return parents.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("ref_value")).distinct().withColumn("periods", F.array(F.struct(F.lit(None).cast("timestamp").alias("b"), F.lit(None).cast("timestamp").alias("e"))))
    return (
        parents.where(F.col(key).isNotNull() & F.col(begins).isNotNull())
        .groupBy(F.col(key).cast("string").alias("ref_value"))
        .agg(F.collect_set(F.struct(F.col(begins).alias("b"), F.col(ends).alias("e"))).alias("periods"))
    )


def orphans(refs: DataFrame, parents: DataFrame, timed: bool, bits_per_key: int = 10, max_blocks: int = bloom.MAX_BLOCKS) -> DataFrame:
    """References of REF format whose key has no row in ``parents`` (of ``periods``), at their time if ``timed``.

    A null end means the period is still open: collect_set keeps a struct with a null field.
    """
    keys = parents.count()
    blocks = bloom.blocks_for(keys, bits_per_key, max_blocks)
    probed = bloom.probe(refs, "ref_value", bloom.build(parents, "ref_value", blocks), blocks)
    certain = probed.where(~F.col("may_exist")).select(*REF)
    possible = probed.where("may_exist").select(*REF)
    if keys <= BROADCAST_KEYS:
        verified = possible.join(F.broadcast(parents), "ref_value", "left")
    else:
        verified = left_join_unique(possible, parents, "ref_value", hot_keys(refs, "ref_value"))
    there = F.expr("exists(periods, p -> p.b <= at and (p.e is null or p.e > at))") if timed else F.col("periods").isNotNull()
    return certain.unionByName(verified.where(~F.coalesce(there, F.lit(False))).select(*REF))


def all_orphans(entities: DataFrame, edges: DataFrame, name_index: DataFrame, source_docs: DataFrame) -> DataFrame:
    """Every orphan reference of the entity and edge tables, in REF format."""
    names = refs_of(entities.select("rec_id", "extracted_at", F.explode("cross_references").alias("x")), "entities", "rec_id", "cross_references", F.col("x"), F.col("extracted_at")).unionByName(
        refs_of(edges, "edges", "edge_id", "target", F.col("target"), F.col("created_at"))
    )
    manuals = refs_of(entities, "entities", "rec_id", "document_id", F.col("document_id"), F.col("extracted_at"))
    rows = refs_of(edges, "edges", "edge_id", "rec_id", F.col("rec_id"), F.col("created_at"))
    return (
        orphans(names, periods(name_index, "name", "indexed_at", "removed_at"), True)
        .unionByName(orphans(manuals, periods(source_docs, "document_id", "registered_at", "withdrawn_at"), True))
        .unionByName(orphans(rows, periods(entities, "rec_id"), False))
    )


def found(*tables: DataFrame) -> DataFrame:
    """(table_name, row_id, column_name, ref_value), distinct."""
    return all_orphans(*tables).select("table_name", "row_id", "column_name", "ref_value").distinct()


def report(*tables: DataFrame) -> DataFrame:
    """Orphan references per table, column and month of the reference."""
    cases = all_orphans(*tables).dropDuplicates(["table_name", "row_id", "column_name", "ref_value"])
    return cases.groupBy("table_name", "column_name", F.date_format("at", "yyyy-MM").alias("month")).agg(
        F.count("*").alias("orphans"), F.countDistinct("ref_value").alias("keys")
    )
