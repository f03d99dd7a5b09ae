"""Queries of the training-data operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm import canonmap, encode, lookalike, mixing, ocrrepair, spam, survivors, truncation
from graphloom.session import small_batches, table


def _one(name: str, op: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return op(table(spark, sf_dir, name))

    return run


def _two(first: str, second: str, op: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return op(table(spark, sf_dir, first), table(spark, sf_dir, second))

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per query; the first of each problem is the one that is compared."""
    return {
        "p2_found": _two("entities", "canon_values", canonmap.found),
        "p2_misses": _two("entities", "canon_values", canonmap.misses),
        "p3_found": _one("entities", lookalike.found),
        "p3_consistent": _one("entities", lookalike.consistent),
        "p3_classes": _one("entities", lookalike.classes),
        "p3_spellings": _one("entities", lookalike.chosen),
        "p4_found": _one("entities", truncation.found),
        "p4_report": _one("entities", truncation.report),
        "p6_found": _one("refined", survivors.found),
        "p6_survivors": _one("refined", lambda r: survivors.survivors(r).withColumn("refined_at", F.date_format("refined_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))),
        "p7_found": _one("ocr_lines", ocrrepair.found),
        "p7_paragraphs": _one("ocr_lines", ocrrepair.paragraphs),
        "p8_ids": _one("documents", encode.encode),
        "p9_mix": _two("documents", "mix_targets", mixing.mix),
        "p9_shares": _two("documents", "mix_targets", mixing.shares),
        "p9_shares_by_characters": _two("documents", "mix_targets", lambda d, t: mixing.shares(d, t, mixing.characters)),
        "p10_found": _one("documents", spam.found),
        "p10_report": _one("documents", spam.report),
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB statements for the queries that SQL can express."""
    from graphloom.llm import oracles

    return oracles.oracle_sql()
