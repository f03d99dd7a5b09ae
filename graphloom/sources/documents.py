"""Entity documents, edge documents and logs kept as JSON files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t

from graphloom.operators.graph import normalized_edges
from graphloom.operators.quality import last_wins
from graphloom.operators.responses import RESPONSE

_ITEM = "array<struct<name string, direction string, type string, description string>>"
#: An entity as stored. Edits may have put a text in place of a struct, so those come as text.
ENTITY = (
    f"id string, name string, entity_type string, description string, syntax string, remarks string, header string, parameters {_ITEM}, members {_ITEM}, return_value string, "
    "requirements struct<header string, library string, dll string, target_platform string, min_server string, min_client string>, deprecated boolean, cross_references array<string>, confidence double, "
    "_source_line int, _source string"
)


def _file_name(column: str = "path") -> Column:
    return F.url_decode(F.element_at(F.split(column, "/"), -1))


def documents(spark: SparkSession, folder: str, skip: str = r"^_|global") -> DataFrame:
    """Entities (ENTITY, source_file) of every *.json document in a folder but those whose name matches ``skip``.

    Names that start with an underscore are invisible to the JSON reader, so files are read as bytes.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(folder).withColumn("source_file", _file_name())
    parsed = F.from_json(F.decode("content", "UTF-8"), f"entities array<struct<{ENTITY}>>", {"mode": "PERMISSIVE"})
    return files.where(~F.col("source_file").rlike(skip)).select("source_file", F.explode(parsed["entities"]).alias("e")).select("e.*", "source_file").where("id <> ''")


def typed_returns(entities: DataFrame) -> DataFrame:
    """``return_value`` as struct(type, description), and ``return_value_text`` where it is a bare text."""
    struct = F.from_json("return_value", "type string, description string")
    is_object = F.col("return_value").startswith("{")
    return entities.withColumns({"return_value_text": F.when(~is_object, F.col("return_value")), "return_value": F.when(is_object, struct)})


def nodes(spark: SparkSession, folder: str) -> DataFrame:
    """One row per id, the last file by name winning."""
    return last_wins(documents(spark, folder), "id", F.col("source_file"))


def edges(spark: SparkSession, path: str) -> DataFrame:
    """Edges of a document that holds them under "edges" or "data"."""
    one = "array<struct<source string, target string, `from` string, `to` string, type string, edge_type string, source_file string>>"
    text = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", f"edges {one}, data struct<edges {one}>")
    rows = text.select(parsed.alias("d")).select(F.explode(F.coalesce("d.edges", "d.data.edges")).alias("e")).select("e.*")
    return normalized_edges(rows)


def no_edges(spark: SparkSession) -> DataFrame:
    """An empty edge table."""
    return spark.createDataFrame([], t.StructType([t.StructField(c, t.StringType()) for c in ("source", "target", "type", "source_file")]))


def answer_log(spark: SparkSession, path: str) -> DataFrame:
    """(entity_id, ord, response) of a log of answers, one JSON object per line; lines that are none are left out.

    ``ord`` follows the time in the line, so that the last answer of an entity wins however files are split.
    """
    rows = spark.read.text(path).select(F.from_json("value", f"entity_id string, timestamp string, response {RESPONSE}").alias("r"))
    kept = rows.select("r.*").where("entity_id <> '' and response is not null")
    return kept.select("entity_id", F.coalesce(F.unix_micros(F.try_to_timestamp("timestamp")), F.lit(0)).alias("ord"), "response")
