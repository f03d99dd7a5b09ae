"""Refinement: contexts of pending nodes to a reviewer, answers to edits, edits to a new graph."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.operators import graph, ops, responses
from graphloom.session import materialize
from graphloom.sources.reviewer import Reviewer


def pending(nodes: DataFrame, processed: DataFrame | None = None, min_confidence: float = 1.0, entity_type: str | None = None, limit: int = 0, order: str = "id") -> DataFrame:
    """Nodes still to review: not processed, at most as sure, of one type, the first ``limit`` by ``order``."""
    out = nodes if processed is None else nodes.join(processed.select("id").distinct(), "id", "left_anti")
    if min_confidence < 1.0:
        out = out.where(F.coalesce("confidence", F.lit(1.0)) <= min_confidence)
    if entity_type:
        out = out.where(F.coalesce("entity_type", F.lit("unknown")) == entity_type)
    return out.orderBy(order).limit(limit) if limit > 0 else out


def estimate(n: int, requests_per_min: int) -> float:
    """Minutes that reviewing n nodes takes."""
    return n / requests_per_min


#: What asking cost, counted with each answer.
USAGE = ("calls", "errors", "tokens_in", "tokens_out")
#: Batches of a run, at most: what a broken-off run loses is one of them.
MAX_BATCHES = 1000


def answers(contexts: DataFrame, reviewer: Reviewer, workers: int = 4) -> DataFrame:
    """(entity_id, raw, calls, errors, tokens_in, tokens_out, ord): the reviewer's answer to each context, asked from ``workers`` tasks.

    Counters are told per answer, so they add up whatever copies of the reviewer the workers hold.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            prompts = [graph.prompt(e, x, [dict(n) if isinstance(n, dict) else n.asDict() for n in (y if y is not None else [])]) for e, x, y in zip(b["entity"], b["edges_shown"], b["neighbours"])]
            rows = []
            for entity_id, text in zip(b["id"], prompts):
                before = [getattr(reviewer, c, 0) for c in USAGE]
                rows.append((entity_id, reviewer(text), *(getattr(reviewer, c, 0) - x for c, x in zip(USAGE, before))))
            yield pd.DataFrame(rows, columns=["entity_id", "raw", *USAGE])

    asked = contexts.repartition(workers, "id").mapInPandas(run, "entity_id string, raw string, " + ", ".join(f"{c} long" for c in USAGE))
    return asked.withColumn("ord", F.xxhash64("entity_id").bitwiseAND(F.lit((1 << 42) - 1)))


def usage(got: DataFrame) -> DataFrame:
    """One row: what all answers cost."""
    return got.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in USAGE])


def in_batches(contexts: DataFrame, reviewer: Reviewer, folder: str, batch: int, workers: int, done: Callable[[DataFrame], None]) -> DataFrame:
    """Parsed answers to all contexts, asked batch by batch; ``done`` gets each batch's before the next one is asked.

    Contexts are written to ``folder`` by batch, so that each batch reads its own alone. What ``done`` has logged is never asked again by a resumed run.
    """
    spark, n = contexts.sparkSession, contexts.count()
    batches = max(1, min(MAX_BATCHES, -(-n // batch)))
    contexts.withColumn("batch", F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int")).write.mode("overwrite").partitionBy("batch").parquet(f"{folder}/contexts")
    every = None
    for i in range(batches if n else 0):
        mine = spark.read.parquet(f"{folder}/contexts").where(F.col("batch") == i).drop("batch")
        got = materialize(responses.parsed(answers(mine, reviewer, workers)).select("entity_id", "ord", "response", *USAGE))
        done(got)
        every = got if every is None else every.unionByName(got)
    return every if every is not None else responses.parsed(answers(contexts.limit(0), reviewer, workers)).select("entity_id", "ord", "response", *USAGE)


def refine(nodes: DataFrame, edges: DataFrame, reviewer: Reviewer, processed: DataFrame | None = None, earlier: DataFrame | None = None, strict: bool = True, workers: int = 4, folder: str | None = None, batch: int = 10, done: Callable[[DataFrame], None] = lambda got: None, agreed: Callable[[DataFrame], bool] = lambda edits: True, **choice) -> tuple[ops.Replayed | None, DataFrame]:
    """(graph after the edits, answers): all contexts are of the graph before any edit.

    ``earlier`` are answers (entity_id, ord, response) of a run that was broken off; they are replayed as well. With a
    ``folder`` contexts are asked in batches of ``batch`` per worker, and ``done`` gets the answers as they come. The graph is None if the edits are not
    ``agreed`` to. Order
    among answers is by entity, so that a run gives the same graph however its tasks are scheduled.
    """
    linked = graph.endpoint_ids(edges, nodes)
    todo = pending(nodes, processed, **choice)
    shown = graph.contexts(nodes, linked).join(todo.select("id"), "id", "left_semi")
    if folder is None:
        got = materialize(responses.parsed(answers(shown, reviewer, workers)).select("entity_id", "ord", "response", *USAGE))
        done(got)
    else:
        got = in_batches(shown, reviewer, folder, batch * workers, workers, done)
    said = got.select("entity_id", "ord", "response")
    every = said if earlier is None else said.unionByName(earlier.join(said.select("entity_id"), "entity_id", "left_anti"))
    numbered = edges.withColumn("edge_no", F.monotonically_increasing_id()) if "edge_no" not in edges.columns else edges
    edits = ops.collected(every)
    return (ops.replay(nodes, materialize(numbered), edits, strict) if agreed(edits) else None), got
