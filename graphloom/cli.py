"""Command line: extract, refine and enrich."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.operators import graph, ops, quality
from graphloom.plans import enrich as E
from graphloom.plans import extract as X
from graphloom.plans import refine as R
from graphloom.session import local_session, materialize
from graphloom.sinks import export
from graphloom.sources import documents, reviewer, text
from graphloom.streaming import incremental


def parser() -> argparse.ArgumentParser:
    """Arguments of all phases."""
    p = argparse.ArgumentParser(prog="graphloom", description=__doc__)
    p.add_argument("--input", required=True, help="folder of scans")
    p.add_argument("--output", required=True, help="folder of tables")
    p.add_argument("--phase", choices=["all", "extract", "refine", "enrich"], default="all")
    p.add_argument("--config", default="", help="JSON file of a chat service; without one, everything is kept")
    p.add_argument("--provider", choices=["deepseek", "ollama"], default="deepseek")
    p.add_argument("--max-entities", type=int, default=0)
    p.add_argument("--min-confidence", type=float, default=1.0)
    p.add_argument("--entity-type")
    p.add_argument("--resume", action="store_true", help="skip nodes reviewed in an earlier run, and replay its answers")
    p.add_argument("--dry-run", action="store_true", help="only say how long a review would take")
    p.add_argument("--review", action="store_true", help="show the edits asked for and ask whether to make them")
    p.add_argument("--force", action="store_true", help="extract scans again that are already known")
    p.add_argument("--compat", action="store_true", help="keep edges that end in a removed node")
    return p


def _exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def run(spark: SparkSession, a: argparse.Namespace) -> None:
    """One run."""
    out = a.output
    config = reviewer.load_config(a.config, a.provider) if a.config else None
    workers = config.max_workers if config else 4
    if a.phase in ("all", "extract"):
        scans = text.scan(spark, a.input)
        known = spark.read.parquet(f"{out}/hashes") if not a.force and _exists(spark, f"{out}/hashes") else None
        todo, hashes = incremental.resume(scans, known) if known is not None else (scans, scans.select("file_name", "md5"))
        if not todo.isEmpty():
            earlier = spark.read.parquet(f"{out}/entities") if known is not None and _exists(spark, f"{out}/entities") else None
            judge = reviewer.Judge(reviewer.ChatClient(config, reviewer.JUDGE)) if config and not a.dry_run else None
            x = X.extract(scans, judge=judge, todo=todo if earlier is not None else None, known=materialize(earlier) if earlier is not None else None)
            export.write_tables(out, entities=x.entities, documents=x.documents, decisions=x.decisions, selected=x.selected, edges=x.edges, index=quality.global_index(_named(x.selected, scans)))
            export.write_tables(out, hashes=materialize(hashes))
    if a.phase in ("all", "refine"):
        nodes, edges = _nodes(spark, out), spark.read.parquet(f"{out}/edges")
        earlier = materialize(documents.answer_log(spark, f"{out}/answers")) if a.resume and _exists(spark, f"{out}/answers") else None
        done = materialize(spark.read.parquet(f"{out}/processed").select("id")) if a.resume and _exists(spark, f"{out}/processed") else None
        choice = {"min_confidence": a.min_confidence, "entity_type": a.entity_type, "limit": a.max_entities}
        if a.dry_run:
            n = R.pending(nodes, done, **choice).count()
            print(f"{n} nodes, {R.estimate(n, config.requests_per_min if config else 60):.1f} minutes")
            return
        who = reviewer.ChatClient(config, share=workers) if config else reviewer.keep_all

        def log(got: DataFrame) -> None:
            export.append_answers(got, f"{out}/answers")
            export.append_processed(got, f"{out}/processed")

        def agreed(edits: DataFrame) -> bool:
            if not a.review:
                return True
            ops.op_counts(edits).show()
            return input("make these edits? [y/N] ").strip().lower() == "y"

        result, got = R.refine(nodes, edges, who, done, earlier, not a.compat, workers, f"{out}/work", config.batch_size if config else 1000, log, agreed, **choice)
        if result is None:
            return
        export.write_tables(f"{out}/refined", nodes=result.nodes, edges=result.edges, counts=result.counts, stats=graph.stats(result.nodes, result.edges), files=export.refined_files(result.nodes), usage=R.usage(got))
        export.write_refined(spark.read.parquet(f"{out}/refined/nodes"), f"{out}/refined/documents")
    if a.phase in ("all", "enrich"):
        base = f"{out}/refined" if _exists(spark, f"{out}/refined/nodes") else out
        nodes = spark.read.parquet(f"{base}/nodes") if base != out else _nodes(spark, out)
        index, edges = E.enrich(nodes, spark.read.parquet(f"{base}/edges"))
        export.write_tables(f"{out}/enriched", index=index, edges=edges)


def _named(entities, scans):
    files = scans.select("doc_id", "src", "file_name")
    return entities.join(files, ["doc_id", "src"]).withColumnRenamed("file_name", "source_file")


def _nodes(spark: SparkSession, out: str):
    rows = spark.read.parquet(f"{out}/selected").withColumn("source_file", F.concat(F.col("doc_id"), F.lit(".json")))
    return quality.last_wins(rows, "id", F.col("doc_id"))


def main(argv: list[str] | None = None) -> None:
    """Entry point."""
    run(local_session(), parser().parse_args(argv))


if __name__ == "__main__":
    main()
