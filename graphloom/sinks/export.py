"""Writers: tables as Parquet, and at the edge one JSON document per file for other programs."""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "kg_v4"


def python_json(value: object) -> str:
    """JSON as the content hash needs it: blanks after commas and colons, characters as they are."""
    return json.dumps(value, ensure_ascii=False)


def pruned(value: object) -> object:
    """A row's value without absent fields."""
    if isinstance(value, dict):
        return {k: pruned(v) for k, v in value.items() if v is not None}
    if isinstance(value, (list, tuple)):
        return [pruned(v) for v in value]
    return value


def content_hash(entities: list[dict]) -> str:
    """First 12 digits of the SHA-256 of a document's entities."""
    import hashlib

    return hashlib.sha256(python_json(entities).encode()).hexdigest()[:12]


#: Order of an entity's fields in a document.
FIELDS = ("id", "name", "entity_type", "description", "syntax", "parameters", "return_value", "remarks", "members", "requirements", "header", "deprecated", "cross_references", "confidence", "source_line")


def entity_dict(row: dict) -> dict:
    """One entity as it stands in a document: absent optional fields left out, the header always there."""
    out = {}
    for k in FIELDS:
        v = pruned(row.get(k))
        if k == "header" or (v is not None and v != [] and v != {}) or k == "cross_references":
            out["_source_line" if k == "source_line" else k] = v if k != "cross_references" else (v or [])
    return out


def document_json(entities: DataFrame, documents: DataFrame, stamp: str | None = None) -> DataFrame:
    """(doc_id, src, json, content_hash): one document per variant; a document's entities are one row already."""
    cols = [c for c in FIELDS if c in entities.columns]
    grouped = entities.groupBy("doc_id", "src").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("ord", *cols))), lambda x: x.dropFields("ord"))).alias("entities"))
    meta = documents.select("doc_id", "src", F.to_json(F.struct("document_id", "title", "domain", "topic", "source_file", "ocr_timestamp", "headers_referenced", "total_entities")).alias("document"))
    when = stamp or datetime.now(UTC).isoformat()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            docs, hashes = [], []
            for es, d in zip(b["entities"], b["document"]):
                held = [entity_dict(e) for e in json.loads(es or "[]")]
                hashes.append(content_hash(held))
                docs.append(python_json({"_schema": SCHEMA, "_generated_at": when, "_content_hash": hashes[-1], "document": json.loads(d), "entities": held}))
            yield pd.DataFrame({"doc_id": b["doc_id"], "src": b["src"], "json": docs, "content_hash": hashes})

    return meta.join(grouped, ["doc_id", "src"], "left").mapInPandas(run, "doc_id string, src string, json string, content_hash string")


def write_tables(path: str, **tables: DataFrame) -> None:
    """Each table as Parquet below ``path``, replacing what was there; per-variant tables by variant."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        (writer.partitionBy("src") if "src" in df.columns else writer).parquet(f"{path}/{name}")


def write_documents(documents: DataFrame, path: str) -> None:
    """One JSON text per row, in one folder per document file."""
    documents.select(F.col("json").alias("value"), "doc_id", "src").write.mode("overwrite").partitionBy("src", "doc_id").text(path)


def append_answers(answers: DataFrame, path: str) -> None:
    """Answers (entity_id, response) appended to a log, one JSON object per line."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    answers.select("entity_id", now.alias("timestamp"), "response").write.mode("append").json(path)


def append_processed(answers: DataFrame, path: str) -> None:
    """The ids of answered nodes, with the time, appended to the table of those a resumed run skips."""
    answers.select(F.col("entity_id").alias("id"), F.current_timestamp().alias("at")).write.mode("append").parquet(path)


def write_refined(nodes: DataFrame, path: str) -> None:
    """The refined nodes as JSON, one line each, in one folder per file they came from; added nodes are in llm_added."""
    nodes.withColumn("source_file", F.coalesce("source_file", F.lit("llm_added"))).write.mode("overwrite").partitionBy("source_file").json(path)


def refined_files(nodes: DataFrame) -> DataFrame:
    """(source_file, entities): nodes per file they came from; added nodes are in llm_added."""
    return nodes.groupBy(F.coalesce("source_file", F.lit("llm_added")).alias("source_file")).agg(F.count("*").alias("entities"))
