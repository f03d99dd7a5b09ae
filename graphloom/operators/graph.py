"""The entity graph as two tables: nodes (id, name, ...) and edges (source, target, type, source_file), by name.

Edges are a multiset, directed as stored and undirected for neighbourhoods; a target need not exist.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.functions import text as T
from graphloom.grammar import OCR
from graphloom.operators.skew import hot_keys, left_join_unique

#: How much of a neighbourhood a context shows.
NEIGHBOURS, EDGES_SHOWN, ITEMS_SHOWN = 15, 25, {"parameters": 8, "members": 10, "cross_references": 10}
TEXT_SHOWN = {"description": 800, "syntax": 500, "neighbour": 150}


def reference_edges(entities: DataFrame, scans: DataFrame | None = None) -> DataFrame:
    """One edge per cross reference; ``scans`` gives the output file of each document, else its id is used."""
    rows = entities
    if scans is not None:
        files = scans.select("doc_id", "src", T.output_name(F.col("file_name")).alias("source_file"))
        rows = entities.join(files, ["doc_id", "src"], "left")
    elif "source_file" not in entities.columns:
        rows = entities.withColumn("source_file", F.col("doc_id"))
    return rows.select(F.col("name").alias("source"), F.explode("cross_references").alias("target"), F.lit("references").alias("type"), "source_file")


def normalized_edges(edges: DataFrame) -> DataFrame:
    """Edges with ``source``, ``target`` and ``type`` under any of the names they come under."""
    have = set(edges.columns)
    first = lambda *names: F.coalesce(*[F.col(n) for n in names if n in have], F.lit(None).cast("string"))
    kept = [c for c in edges.columns if c not in {"source", "from", "target", "to", "type", "edge_type"}]
    return edges.select(first("source", "from").alias("source"), first("target", "to").alias("target"), F.coalesce(first("type", "edge_type"), F.lit("unknown")).alias("type"), *kept)


def endpoint_ids(edges: DataFrame, nodes: DataFrame, namespace: str = OCR.namespace) -> DataFrame:
    """Edges with source_id and target_id; a name without a node gets the id it would have.

    The node side is unique by name; edges of a name that many edges hold stay where they are.
    """
    ids = nodes.where("name is not null").groupBy("name").agg(F.max("id").alias("id"))
    for end in ("source", "target"):
        named = ids.select(F.col("name").alias(end), F.col("id").alias(f"{end}_id"))
        edges = left_join_unique(edges, named, end, hot_keys(edges, end)).withColumn(f"{end}_id", F.coalesce(f"{end}_id", F.concat(F.lit(f"{namespace}::"), F.col(end))))
    return edges


def adjacency(edges: DataFrame) -> DataFrame:
    """(id, other) of both directions, distinct; a self edge once."""
    both = edges.select(F.col("source_id").alias("id"), F.col("target_id").alias("other")).unionByName(edges.select(F.col("target_id").alias("id"), F.col("source_id").alias("other")))
    return both.where("id is not null and other is not null").distinct()


def neighbours(edges: DataFrame, nodes: DataFrame, most: int = NEIGHBOURS) -> DataFrame:
    """(id, rank, other, name, entity_type, description): neighbours that are nodes first, then others, by id.

    Only ``most`` of each are the feature; they are cut by a group limit before the window, so a hub's neighbours
    are never sorted in one task as a whole.
    """
    known = nodes.select(F.col("id").alias("other"), "name", "entity_type", T.truncate(F.col("description"), TEXT_SHOWN["neighbour"]).alias("description"))
    met = adjacency(edges).join(known, "other", "left").withColumn("external", F.col("name").isNull())
    salted = met.withColumn("salt", F.pmod(F.xxhash64("other"), F.lit(32)))
    order = ["external", "other"]
    cut = salted.withColumn("r", F.row_number().over(W.partitionBy("id", "salt").orderBy(*order))).where(F.col("r") <= most)
    ranked = cut.withColumn("rank", F.row_number().over(W.partitionBy("id").orderBy(*order))).where(F.col("rank") <= most)
    bare = F.regexp_replace("other", f"^{OCR.namespace}::", "")
    return ranked.select(
        "id", "rank", "other", F.coalesce("name", bare).alias("name"), F.when(F.col("external"), "external_ref").otherwise(F.coalesce("entity_type", F.lit("unknown"))).alias("entity_type"),
        F.when(F.col("external"), "(未在图谱中)").otherwise(F.col("description")).alias("description"),
    )


def type_counts(nodes: DataFrame) -> DataFrame:
    """Nodes per type."""
    return nodes.groupBy(F.coalesce("entity_type", F.lit("unknown")).alias("entity_type")).agg(F.count("*").alias("n"))


def stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: total_entities, total_edges, avg_degree."""
    rows = nodes.select(F.lit(1).alias("v"), F.lit(0).alias("e")).unionByName(edges.select(F.lit(0).alias("v"), F.lit(1).alias("e")))
    sums = rows.agg(F.coalesce(F.sum("v"), F.lit(0)).alias("total_entities"), F.coalesce(F.sum("e"), F.lit(0)).alias("total_edges"))
    return sums.withColumn("avg_degree", F.bround(2 * F.col("total_edges") / F.greatest("total_entities", F.lit(1)), 2))


def degrees(edges: DataFrame) -> DataFrame:
    """(id, degree) over both directions; a self edge counts twice."""
    ends = edges.select(F.explode(F.array("source_id", "target_id")).alias("id"))
    return ends.where("id is not null").groupBy("id").agg(F.count("*").alias("degree"))


def contexts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, entity, edges_shown, neighbours): what a reviewer is shown of each node, as JSON and arrays."""
    cut = [
        F.slice(c, 1, ITEMS_SHOWN[c]).alias(c) if c in ITEMS_SHOWN else T.truncate(F.col(c), TEXT_SHOWN[c]).alias(c) if c in ("description", "syntax") else F.col(c)
        for c in ("id", "name", "entity_type", "description", "confidence", "syntax", "parameters", "return_value", "remarks", "members", "requirements", "header", "cross_references")
        if c in nodes.columns
    ]
    shown = F.concat(F.col("source"), F.lit(" --["), F.col("type"), F.lit("]--> "), F.col("target"))
    both = edges.select(F.explode(F.array_distinct(F.array("source_id", "target_id"))).alias("id"), shown.alias("line"))
    salted = both.withColumn("salt", F.pmod(F.xxhash64("line"), F.lit(32)))
    first = salted.withColumn("r", F.row_number().over(W.partitionBy("id", "salt").orderBy("line"))).where(F.col("r") <= EDGES_SHOWN)
    lines = first.withColumn("r", F.row_number().over(W.partitionBy("id").orderBy("line"))).where(F.col("r") <= EDGES_SHOWN).groupBy("id").agg(F.array_sort(F.collect_set("line")).alias("edges_shown"))
    near = neighbours(edges, nodes).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("rank", "name", "entity_type", "description"))).alias("neighbours"))
    return nodes.select("id", F.to_json(F.struct(*cut)).alias("entity")).join(lines, "id", "left").join(near, "id", "left")


def prompt(entity: str, edges_shown: list[str] | None, near: list[dict] | None) -> str:
    """Text of one context for a reviewer."""
    out = ["## 当前实体\n", f"```json\n{entity}\n```\n"]
    if edges_shown is not None and len(edges_shown):
        out += [f"\n## 连接的边（共 {len(edges_shown)} 条）\n", *[f"- {e}" for e in edges_shown], ""]
    if near is not None and len(near):
        out += [f"\n## 邻居实体（{len(near)} 个）\n", *[f"- **{n['name']}** ({n['entity_type']}): {n['description'] or '(无描述)'}" for n in near], ""]
    return "\n".join(out)
