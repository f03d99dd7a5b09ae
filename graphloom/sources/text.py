"""Scanned text files: listing, pairing of variants, whole-text scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions import text as T

#: Names of scans; brackets are escaped, since a glob takes them for a class.
SCANS = r"\[OCR\]*.txt"


def scan(spark: SparkSession, folder: str, pattern: str = SCANS) -> DataFrame:
    """(doc_id, src, file_name, text, md5) of every scan in a folder; bytes are read once.

    ``src`` is "p" for files ending in .p.txt, else "t"; ``doc_id`` is the name without that ending.
    """
    name = F.url_decode(F.element_at(F.split("path", "/"), -1))
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).withColumn("file_name", name)
    return files.select(
        F.regexp_replace("file_name", r"(\.p)?\.txt$", "").alias("doc_id"),
        F.when(F.col("file_name").endswith(".p.txt"), "p").otherwise("t").alias("src"),
        "file_name",
        F.decode("content", "UTF-8").alias("text"),
        F.md5("content").alias("md5"),
    )


def pairs(scans: DataFrame) -> DataFrame:
    """(base, p_file, t_file): full outer join of the two variants of each document."""
    side = lambda s: scans.where(F.col("src") == s).select(F.col("doc_id").alias("base"), F.col("file_name").alias(f"{s}_file"))
    return side("p").join(side("t"), "base", "full_outer")


def document_meta(scans: DataFrame, titles: DataFrame, headers: DataFrame, entities: DataFrame) -> DataFrame:
    """One row of metadata per document variant."""
    meta = T.file_meta(F.col("file_name"))
    counts = entities.groupBy("doc_id", "src").agg(F.count("*").cast("int").alias("total_entities"))
    return (
        scans.select("doc_id", "src", F.col("file_name").alias("source_file"), meta.alias("m"))
        .join(titles, ["doc_id", "src"], "left").join(headers, ["doc_id", "src"], "left").join(counts, ["doc_id", "src"], "left")
        .select(
            "doc_id", "src", F.concat("m.domain", F.lit("::"), "m.topic").alias("document_id"), F.coalesce("title", F.lit("")).alias("title"), "m.domain", "m.topic", "source_file",
            F.col("m.ocr_time").alias("ocr_timestamp"), F.coalesce("headers_referenced", F.array().cast("array<string>")).alias("headers_referenced"),
            F.coalesce("total_entities", F.lit(0)).alias("total_entities"),
        )
    )
