"""Ordered log of graph edits, replayed on node and edge tables by joins.

An edit belongs to the node under review. Nodes with a deletion, and nodes merged into one that is there, take no
other edits. Removal times are found by iterating joins until they settle: whether a merge happens depends only on
earlier removals, so the rounds needed are the depth of merges into merged nodes, not the length of the log.

An edge keeps its name until a merge after it was drawn renames an end; deletions meet it under the name it has then. A merged
node's fields go to the first node they reach that lacks them, along the whole chain. Edges are known by (origin, edge_no): 0 for those of the graph,
1 for those drawn, whose number is that of their edit.

Defined results. Edits without a node, target or known field are skipped and counted. A node merged into itself is
removed. A removed node that is added again stays. ``strict`` drops edges that end in a removed node; without it
only those whose removed name was added again are dropped, as a compatible run does.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.grammar import EDITABLE, EDITS, OCR
from graphloom.operators.skew import hot_keys, left_join_unique
from graphloom.session import materialize

#: Later than every edit.
FOREVER = (1 << 63) - 1
_FILLED = ("description", "syntax", "return_value", "remarks", "header", "parameters", "members", "cross_references")


@dataclass
class Replayed:
    """Nodes and edges after the edits, and counts by kind of edit."""

    nodes: DataFrame
    edges: DataFrame
    counts: DataFrame


def collected(answers: DataFrame) -> DataFrame:
    """(seq, entity_id, op, ...) of answers (entity_id, ord, response), one answer per entity, the last one.

    A verdict to delete without a deletion among its operations adds one. Edits are numbered by (ord, entity_id, place in the answer): a range
    sort, so numbers never collide, whatever ``ord`` holds.
    """
    last = answers.groupBy("entity_id").agg(F.max_by(F.struct("ord", "response"), "ord").alias("x")).select("entity_id", "x.ord", "x.response")
    ops = F.col("response.operations")
    implied = (F.col("response.verdict") == "delete") & ~F.exists(ops, lambda o: o["op"] == "delete_node")
    null = F.lit(None).cast("string")
    delete = F.struct(F.lit("delete_node").alias("op"), *[null.alias(c) for c in ("field", "value", "target", "edge_type", "name", "entity_type", "description")], F.col("response.summary").alias("reason"), null.alias("target_id"))
    every = F.when(implied, F.concat(ops, F.array(delete))).otherwise(ops)
    rows = last.select("entity_id", "ord", F.posexplode(every).alias("i", "o")).orderBy("ord", "entity_id", "i")
    return materialize(rows.select(F.monotonically_increasing_id().alias("seq"), "entity_id", "o.*"))


def _filled(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c) != "")


def removals(ops: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(blocked ids with ``deletes``/``merges``, deletions (id, at), merges (id, into, at)) that take place."""
    ids = nodes.select("id")
    asked_delete = ops.where("op = 'delete_node'").groupBy(F.col("entity_id").alias("id")).agg(F.min("seq").alias("at"))
    merges = ops.where((F.col("op") == "merge_into") & _filled("target_id")).select(F.col("entity_id").alias("id"), F.col("target_id").alias("into"), "seq")
    merges = merges.join(ids.withColumnRenamed("id", "into"), "into", "left_semi")
    blocked = asked_delete.select("id", F.lit(True).alias("deletes"), F.lit(False).alias("merges")).unionByName(merges.select("id", F.lit(False).alias("deletes"), F.lit(True).alias("merges")))
    blocked = materialize(blocked.groupBy("id").agg(F.max("deletes").alias("deletes"), F.max("merges").alias("merges")))
    there = blocked.join(ids, "id", "left_semi")
    deletions = asked_delete.join(there.where(~F.col("merges")), "id", "left_semi")
    open_ = materialize(merges.join(there.where(~F.col("deletes")), "id", "left_semi"))
    gone = materialize(deletions)
    done = open_.limit(0).select("id", "into", F.col("seq").alias("at"))
    while True:
        removed = gone.select(F.col("id").alias("into"), F.col("at").alias("into_gone"))
        ready = open_.join(removed, "into", "left").where(F.col("into_gone").isNull() | (F.col("into_gone") >= F.col("seq")))
        now = materialize(ready.groupBy("id").agg(F.min_by("into", "seq").alias("into"), F.min("seq").alias("at")))
        changed = not now.exceptAll(done).unionByName(done.exceptAll(now)).isEmpty()
        done, gone = now, materialize(deletions.select("id", "at").unionByName(now.select("id", "at")))
        if not changed:
            return blocked, deletions.select("id", "at"), done


def paths(merges: DataFrame) -> DataFrame:
    """(id, hop, into, at, times): every node that a merged one passes on to, hop by hop; ``times`` from the last hop back to the first.

    A merge into a node that was merged before never takes place, so the times of a path rise and it never returns.
    """
    step = merges.where(F.col("id") != F.col("into")).select(F.col("id").alias("into"), F.col("into").alias("next"), F.col("at").alias("next_at"))
    reached = materialize(merges.where(F.col("id") != F.col("into")).select("id", F.lit(1).alias("hop"), "into", "at", F.array("at").alias("times")))
    every = reached
    while True:
        reached = materialize(reached.join(step, "into").select("id", (F.col("hop") + 1).alias("hop"), F.col("next").alias("into"), F.col("next_at").alias("at"), F.concat(F.array("next_at"), "times").alias("times")))
        if reached.isEmpty():
            return every
        every = every.unionByName(reached)


def _versions(edges: DataFrame, hops: DataFrame) -> DataFrame:
    """``edges`` with the names of their ends from ``since`` until before ``until``, one row per period.

    ``hops`` (name, hop, to, at) are the renamings of names; an end is renamed by those after its edge was drawn.
    """
    out = edges.withColumns({"since": F.col("added_at"), "until": F.lit(FOREVER)})
    first = hops.where("hop = 1").select("name", F.col("at").alias("begins"))
    spans = hops.join(first, "name").groupBy("name", "begins").agg(F.array_sort(F.collect_list(F.struct("at", "to"))).alias("spans"))
    for end in ("source", "target"):
        named = spans.select(F.col("name").alias(end), "begins", "spans")
        joined = left_join_unique(out, named, end, hot_keys(out, end))
        later = F.coalesce(F.col("begins") > F.col("added_at"), F.lit(False))
        start = F.array(F.struct(F.lit(-1).cast("long").alias("at"), F.col(end).alias("to")))
        joined = joined.withColumn("spans", F.when(later, F.concat(start, "spans")).otherwise(start))
        one = joined.select(*out.columns, F.posexplode("spans").alias("i", "span"), "spans")
        ends = F.coalesce(F.try_element_at("spans", F.col("i") + 2)["at"], F.lit(FOREVER))
        out = one.withColumns({end: F.col("span.to"), "since": F.greatest("since", "span.at"), "until": F.least("until", ends)}).where("since < until").select(*out.columns)
    return out


def _deleted_edges(versions: DataFrame, deletes: DataFrame) -> DataFrame:
    """(origin, edge_no, seq) of the edges that deletions take: each the first one there of its unordered pair, and type if given.

    Of a pair with n deletions only the first n edges per type that are there all along can be taken; renamed and drawn ones are
    kept besides, so no group outgrows its own deletions and merges. What is taken under one name is missing under later ones: passes are repeated
    until nothing changes, at most as often as an edge is renamed.
    """
    pair = lambda a, b: F.concat_ws("\x01", F.least(a, b), F.greatest(a, b))
    d = materialize(deletes.select(pair("source", "target").alias("pair"), "seq", F.col("edge_type").alias("wanted")))
    n = d.groupBy("pair").agg(F.count("*").alias("n"))
    whole = (F.col("since") == -1) & (F.col("until") == FOREVER)
    near = versions.withColumn("pair", pair("source", "target")).join(n, "pair")
    near = near.withColumn("r", F.row_number().over(W.partitionBy("pair", "type", whole).orderBy("origin", "edge_no"))).where(~whole | (F.col("r") <= F.col("n")))
    near = materialize(near.select("pair", "origin", "edge_no", "type", "since", "until"))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        free, taken = left.sort_values(["origin", "edge_no"]).to_dict("records"), []
        for op in right.sort_values("seq").itertuples():
            hit = next((x for x in free if x["since"] < op.seq < x["until"] and (not op.wanted or x["type"] == op.wanted)), None)
            if hit is not None:
                free.remove(hit)
                taken.append((hit["origin"], hit["edge_no"], op.seq))
        return pd.DataFrame(taken, columns=["origin", "edge_no", "seq"])

    taken: DataFrame | None = None
    while True:
        left = near
        if taken is not None:
            left = near.join(taken, ["origin", "edge_no"], "left").where("seq is null or since < seq").drop("seq")
        now = left.groupBy("pair").cogroup(d.groupBy("pair")).applyInPandas(run, "origin int, edge_no long, seq long")
        now = materialize(now.groupBy("origin", "edge_no").agg(F.min("seq").alias("seq")))
        if now.isEmpty() or (taken is not None and now.exceptAll(taken).isEmpty() and taken.exceptAll(now).isEmpty()):
            return now
        taken = now


def replay(nodes: DataFrame, edges: DataFrame, ops: DataFrame, strict: bool = True, namespace: str = OCR.namespace) -> Replayed:
    """Nodes (id, name, ...) and edges (edge_no, source, target, type, source_file) after the edits ``ops``."""
    ops, nodes = materialize(ops), materialize(nodes)
    blocked, deletions, merges = removals(ops, nodes)
    deletions, merges = materialize(deletions), materialize(merges)
    passed = paths(merges)
    free = ops.join(blocked, F.col("entity_id") == F.col("id"), "left_anti")

    node_id = F.concat(F.lit(f"{namespace}::"), F.col("name"))
    gone = deletions.unionByName(merges.select("id", "at"))
    wish = free.where((F.col("op") == "add_node") & _filled("name")).select(node_id.alias("id"), "name", "entity_type", "description", "seq")
    state = wish.join(nodes.select("id", F.lit(True).alias("was")), "id", "left").join(gone, "id", "left")
    may = F.col("was").isNull() | (F.col("at") < F.col("seq"))
    added = materialize(state.where(may).groupBy("id").agg(F.min_by(F.struct("name", "entity_type", "description", "seq"), "seq").alias("x")).select("id", "x.*"))

    present = nodes.select("id", "name", F.lit(-1).cast("long").alias("since")).unionByName(added.select("id", "name", F.col("seq").alias("since")))
    owned = free.join(present.select(F.col("id").alias("entity_id"), F.col("name").alias("source"), "since"), "entity_id").where("since < seq")

    changes = owned.where((F.col("op") == "update_field") & F.col("field").isin(*EDITABLE))
    last = changes.groupBy("entity_id", "field").agg(F.max_by("value", "seq").alias("value")).groupBy(F.col("entity_id").alias("id")).agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("edits"))
    types = dict(nodes.dtypes)
    kept = nodes.join(gone, "id", "left_anti").join(last, "id", "left")

    fills = [c for c in _FILLED if c in types]
    if fills:
        empty = lambda c: F.col(c).isNull() | ((F.size(c) == 0) if types[c].startswith("array") else (F.col(c) == "") if types[c] == "string" else F.lit(False))
        donors = passed.join(nodes.select("id", *fills), "id")
        donated = donors.groupBy(F.col("into").alias("id")).agg(*[F.min_by(c, F.when(~empty(c), F.col("times"))).alias(f"from_{c}") for c in fills])
        kept = kept.join(donated, "id", "left")
    for c in nodes.columns:
        if c in EDITABLE:
            new = F.element_at("edits", c)
            edited = new if types[c] == "string" else new.cast("boolean") if types[c] == "boolean" else F.from_json(new, types[c])
            kept = kept.withColumn(c, F.when(F.coalesce(F.array_contains(F.map_keys("edits"), c), F.lit(False)), edited).otherwise(F.col(c)))
        if c in fills:
            kept = kept.withColumn(c, F.when(empty(c) & F.col(f"from_{c}").isNotNull(), F.col(f"from_{c}")).otherwise(F.col(c)))
    made = added.select(
        *[
            F.col(c) if c in ("id", "name", "description") else F.coalesce("entity_type", F.lit("unknown")).alias(c) if c == "entity_type" else F.lit(0.7).alias(c) if c == "confidence"
            else F.lit("llm_added").alias(c) if c == "source_file" else F.lit(None).cast(types[c]).alias(c)
            for c in nodes.columns
        ]
    )
    new_nodes = kept.select(*nodes.columns).unionByName(made)

    new = owned.where((F.col("op") == "add_edge") & _filled("target") & _filled("source"))
    files = nodes.select(F.col("id").alias("entity_id"), "source_file") if "source_file" in types else None
    new = new.join(files, "entity_id", "left") if files is not None else new.withColumn("source_file", F.lit(None).cast("string"))
    key = ("origin", "edge_no")
    drawn = new.select(F.lit(1).alias("origin"), F.col("seq").alias("edge_no"), "source", "target", F.coalesce("edge_type", F.lit("references")).alias("type"), F.coalesce("source_file", F.lit("llm")).alias("source_file"), F.col("seq").alias("added_at"))
    old = edges.select(F.lit(0).alias("origin"), "edge_no", "source", "target", "type", "source_file", F.lit(-1).cast("long").alias("added_at"))
    names = nodes.select("id", "name")
    hops = passed.join(names, "id").select("name", "hop", F.col("into").alias("id"), "at").join(names.withColumnRenamed("name", "to"), "id").select("name", "hop", "to", "at")
    versions = materialize(_versions(old.unionByName(drawn), hops))

    deletes = owned.where((F.col("op") == "delete_edge") & _filled("target") & _filled("source"))
    taken = _deleted_edges(versions, deletes)
    left = versions.where(F.col("until") == FOREVER).join(taken, list(key), "left_anti")
    lost = deletions.join(nodes.select("id", "name"), "id").select("name").unionByName(merges.join(nodes.select("id", "name"), "id").select("name"))
    again = lost.join(added.select("name"), "name", "left_semi")
    drop = (lost.join(added.select("name"), "name", "left_anti") if strict else again).distinct()
    for end in ("source", "target"):
        left = left.join(drop.withColumnRenamed("name", end), end, "left_anti")

    count = lambda df, name: df.select(F.lit(name).alias("op"))
    done = (
        count(changes, "update_field").unionByName(count(new, "add_edge")).unionByName(count(taken, "delete_edge")).unionByName(count(added, "add_node"))
        .unionByName(count(deletions, "delete_node")).unionByName(count(merges, "merge_into"))
    )
    counts = done.groupBy("op").agg(F.count("*").alias("n"))
    all_ = ops.where(F.col("op").isin(*EDITS)).select(F.lit("skipped").alias("op"), F.lit(1).alias("v")).unionByName(done.select(F.lit("skipped").alias("op"), F.lit(-1).alias("v")))
    return Replayed(new_nodes, left.drop("added_at", "since", "until"), counts.unionByName(all_.groupBy("op").agg(F.sum("v").alias("n"))))


def op_counts(ops: DataFrame) -> DataFrame:
    """Edits per kind, as asked for."""
    return ops.groupBy("op").agg(F.count("*").alias("n"))
