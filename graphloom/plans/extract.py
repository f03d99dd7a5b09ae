"""Extraction end to end: scans to entities, scores, selection and edges.

The plan shuffles lines once by document for all windows, segments once by document and name for merging, and
references by name. Nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from graphloom.grammar import OCR, Grammar
from graphloom.operators import entities as E
from graphloom.operators import graph, lines, quality, segments
from graphloom.session import materialize
from graphloom.sources import text as source


@dataclass
class Extraction:
    """What an extraction gives; every member is a DataFrame."""

    documents: DataFrame
    entities: DataFrame
    lexicon: DataFrame
    scores: DataFrame
    decisions: DataFrame
    selected: DataFrame
    edges: DataFrame


def entities_of(line_rows: DataFrame, g: Grammar = OCR, lexicon: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(entities, lexicon) of lines (doc_id, src, line_no, text)."""
    classified = materialize(lines.classify(line_rows, g))
    names = lexicon if lexicon is not None else lines.lexicon(classified)
    merged = materialize(E.merged(E.parsed(segments.segments(segments.segment_lines(classified)), g)))
    return E.finished(merged, E.cross_references(merged, names, g), g), names


def extract(scans: DataFrame, g: Grammar = OCR, judge=None, todo: DataFrame | None = None, known: DataFrame | None = None) -> Extraction:
    """Extraction of scans (doc_id, src, file_name, text, md5).

    With ``todo`` only those scans are parsed, with the names of all; the entities of the others are taken from ``known``, an earlier run's.
    """
    line_rows = lines.explode_lines(scans.select("doc_id", "src", "text"))
    if todo is None or known is None:
        found, names = entities_of(line_rows, g)
    else:
        names = materialize(lines.lexicon(lines.classify(line_rows, g)))
        new, _ = entities_of(lines.explode_lines(todo.select("doc_id", "src", "text")), g, names)
        kept = known.join(todo.select("doc_id", "src"), ["doc_id", "src"], "left_anti").join(scans.select("doc_id", "src"), ["doc_id", "src"], "left_semi")
        found = new.unionByName(kept.select(*new.columns))
    found = materialize(found)
    documents = source.document_meta(scans, lines.title(line_rows, g), lines.headers_referenced(line_rows), found)
    scores = quality.scores(found)
    decisions = quality.decide(scans.select("doc_id", "src").distinct(), scores)
    if judge is not None:
        decisions = quality.adjudicate(decisions, found, judge)
    selected = quality.selected(found, decisions)
    return Extraction(documents, found, names, scores, decisions, selected, graph.reference_edges(selected, scans))


def extract_folder(spark: SparkSession, folder: str, g: Grammar = OCR, judge=None) -> Extraction:
    """Extraction of all scans in a folder."""
    return extract(source.scan(spark, folder), g, judge)
