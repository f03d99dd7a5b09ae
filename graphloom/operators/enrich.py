"""Edges from functions to the types in their parameters and return values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions import text as T
from graphloom.grammar import TYPE_NODES
from graphloom.operators.graph import normalized_edges
from graphloom.operators.skew import hot_keys

#: Edge types drawn for a type in a parameter and in a return value.
PARAMETER_EDGES, RETURN_EDGES = ("parameter_type", "uses"), ("return_type", "returns")


def typed_index(entities: DataFrame) -> DataFrame:
    """(id, name, entity_type) of every entity that has an id and a name, types normalized; names may repeat."""
    return entities.where("id <> '' and name <> ''").select("id", "name", T.normalize_type(F.col("entity_type")).alias("entity_type"))


def clean_types(entities: DataFrame) -> DataFrame:
    """``entities`` with normalized types, the original kept in ``_type_raw`` where it changed."""
    new = T.normalize_type(F.col("entity_type"))
    return entities.withColumn("_type_raw", F.when(~F.col("entity_type").eqNullSafe(new), F.col("entity_type"))).withColumn("entity_type", new)


def uses(entities: DataFrame) -> DataFrame:
    """(source, token, edge_type, source_file): type words of functions. A text return value counts as its type."""
    kinds = dict(entities.dtypes)
    rv = F.col("return_value") if kinds.get("return_value") == "string" else F.col("return_value.type")
    functions = entities.where((T.normalize_type(F.col("entity_type")) == "function") & (F.col("name") != ""))
    tokens = lambda c: F.transform(T.type_tokens(c), lambda t: t)
    params = F.flatten(F.transform(F.coalesce("parameters", F.array().cast(kinds["parameters"])), lambda p: tokens(p["type"])))
    every = F.array(F.struct(params.alias("tokens"), F.array(*map(F.lit, PARAMETER_EDGES)).alias("types")), F.struct(tokens(rv).alias("tokens"), F.array(*map(F.lit, RETURN_EDGES)).alias("types")))
    one = functions.select(F.col("name").alias("source"), "source_file", F.explode(every).alias("u")).select("source", "source_file", "u.types", F.explode(F.array_distinct("u.tokens")).alias("token"))
    return one.select("source", "source_file", "token", F.explode("types").alias("type"))


def type_edges(entities: DataFrame, edges: DataFrame) -> DataFrame:
    """New edges (source, target, type, source_file): to type nodes by name, unless there in either direction.

    Type nodes are distinct names; a type that a large share of functions use meets them by broadcast of that name
    alone, all others by shuffle.
    """
    nodes = typed_index(entities).where(F.col("entity_type").isin(*TYPE_NODES)).select(F.col("name").alias("token")).distinct()
    asked = uses(entities)
    hot = hot_keys(asked, "token")
    is_hot = F.coalesce(F.col("token").isin(hot), F.lit(False)) if hot else F.lit(False)
    met = asked.where(~is_hot).join(nodes, "token", "left_semi")
    if hot:
        met = met.unionByName(asked.where(is_hot).join(F.broadcast(nodes.where(F.col("token").isin(hot))), "token", "left_semi"))
    key = lambda a, b: (F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
    fresh = met.select("source", F.col("token").alias("target"), "type", "source_file", *key("source", "token"))
    held = normalized_edges(edges).where("source <> '' and target <> ''").select(*key("source", "target"), "type").distinct()
    new = fresh.join(held, ["lo", "hi", "type"], "left_anti")
    first = F.min(F.struct("source_file", "source", "target")).alias("e")
    return new.groupBy("lo", "hi", "type").agg(first).select("e.source", "e.target", "type", "e.source_file")


def enriched(entities: DataFrame, edges: DataFrame) -> DataFrame:
    """All edges with the new ones, marked in ``_v41``."""
    old = normalized_edges(edges).select("source", "target", "type", "source_file", F.lit(False).alias("_v41"))
    return old.unionByName(type_edges(entities, edges).withColumn("_v41", F.lit(True)))
