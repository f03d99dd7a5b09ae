"""Queries of the extraction, graph and enrichment operators over the driver's tables.

Lines come from ``ocr_lines`` (a file is a document), nodes and references from ``entities`` and ``edges``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions import text as T
from graphloom.grammar import EXTRACTED_TYPES, GENERIC, KNOWN_TYPES, OCR, TYPE_WORDS
from graphloom.operators import enrich, entities, fields, graph, lines, ops, quality, responses, segments
from graphloom.plans import extract, refine
from graphloom.session import small_batches, table
from graphloom.sinks import export

Query = Callable[[SparkSession, str], DataFrame]


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines (doc_id, src, line_no, text, line_id) of all scans."""
    return table(spark, d, "ocr_lines").where("file_name is not null").select(F.col("file_name").alias("doc_id"), F.coalesce("src", F.lit("t")).alias("src"), "line_no", F.coalesce("text", F.lit("")).alias("text"), "line_id")


def _entities(spark: SparkSession, d: str) -> DataFrame:
    """Entities as an extraction gives them."""
    return table(spark, d, "entities").withColumnsRenamed({"document_id": "doc_id", "entity_id": "id"}).withColumn("ord", F.col("rec_id"))


def _with_types(spark: SparkSession, d: str) -> DataFrame:
    """Entities, and one for each type that their signatures name, as a manual of types would give them."""
    e = _entities(spark, d).select("id", "name", "entity_type", "parameters", F.struct("return_value.type", "return_value.description").alias("return_value"), "source_file")
    named = ("PVOID", "SIZE_T", "UINT64", "BYTE", "ULONG", "UINT32", "INT16", "WCHAR", "HANDLE", "DWORD")
    kinds = {c: t for c, t in e.dtypes}
    types = spark.range(1).select(F.explode(F.array(*map(F.lit, named))).alias("name")).select(F.concat(F.lit("windows::"), "name").alias("id"), "name", F.lit("Typedef ").alias("entity_type"), *[F.lit(None).cast(kinds[c]).alias(c) for c in ("parameters", "return_value")], F.lit("types.json").alias("source_file"))
    return e.unionByName(types)


def _nodes(spark: SparkSession, d: str) -> DataFrame:
    """One node per name, the last row winning."""
    rows = _entities(spark, d).where("name is not null").select("name", F.concat(F.lit("windows::"), F.col("name")).alias("id"), "entity_type", "description", "syntax", "remarks", "header", "confidence", "cross_references", "source_file", "rec_id")
    return quality.last_wins(rows, "name", F.col("rec_id"))


def _edges(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "edges").where("source is not null and target is not null and target <> ''")
    return rows.select(F.col("edge_id").alias("edge_no"), "source", "target", F.coalesce("edge_type", F.lit("unknown")).alias("type"), "source_file")


def _linked(spark: SparkSession, d: str) -> DataFrame:
    return graph.endpoint_ids(_edges(spark, d), _nodes(spark, d))


def _classified(spark: SparkSession, d: str) -> DataFrame:
    return lines.classify(_lines(spark, d), GENERIC)


def _answers(spark: SparkSession, d: str) -> DataFrame:
    """(refined_id, entity_id, ord, raw): a reviewer's answer to each refined row, as clean or damaged text by its key.

    By its key a row edits fields, draws or deletes an edge (of a type, or of any), adds a node, merges its node into that of a following row,
    or is to be deleted without an operation saying so. Targets are real names, so merges, chains of them and deletions take place.
    """
    small_batches(spark)
    rows = table(spark, d, "refined").where("name is not null and refined_id is not null").select("refined_id", "name", "entity_type", F.coalesce("description", F.lit("")).alias("description"))
    step = F.when(F.col("refined_id") % 14 == 6, 7).otherwise(1)
    ahead = rows.select(F.col("refined_id").alias("ahead"), F.col("name").alias("other"))
    known = table(spark, d, "edges").where("target <> ''").groupBy(F.col("source").alias("name")).agg(F.min("target").alias("linked"))
    every = rows.withColumn("ahead", F.col("refined_id") + step).join(ahead, "ahead", "left").join(known, "name", "left").withColumn("other", F.coalesce("other", "name"))
    every = every.selectExpr(
        "refined_id", "concat('windows::', name) AS entity_id", "refined_id AS ord", "refined_id % 12 AS form", "name", "other", "linked", "entity_type", "description",
        "element_at(array('keep', 'keep', 'keep', 'keep', 'keep', 'delete', 'merge'), CAST(refined_id % 7 + 1 AS INT)) AS verdict",
    )
    op = lambda kind, **fields: F.struct(F.lit(kind).alias("op"), *[(fields[c] if c in fields else F.lit(None).cast("string")).alias(c) for c in ("field", "value", "target", "edge_type", "name", "entity_type", "description", "target_id")])
    pick = F.element_at(F.array(F.lit("description"), F.lit("header"), F.lit("color")), (F.col("refined_id") % 3 + 1).cast("int"))
    typed = F.when(F.col("refined_id") % 2 == 1, "references")
    made = {
        0: [op("update_field", field=pick, value=F.col("description")), op("add_edge", target=F.col("other"), edge_type=F.lit("uses"))],
        1: [op("add_edge", target=F.col("other"), edge_type=F.lit("uses"))],
        2: [op("delete_edge", target=F.coalesce("linked", "other"), edge_type=typed)],
        3: [op("add_node", name=F.concat("name", F.lit("_NEW")), entity_type=F.col("entity_type"), description=F.col("description"))],
        4: [op("update_field", field=F.lit("entity_type"), value=F.lit("enum"))],
        6: [op("merge_into", target_id=F.concat(F.lit("windows::"), F.col("other")))],
    }
    none = F.array().cast("array<struct<op:string,field:string,value:string,target:string,edge_type:string,name:string,entity_type:string,description:string,target_id:string>>")
    listed = F.coalesce(*[F.when(F.col("refined_id") % 7 == k, F.array(*v)) for k, v in made.items()], none)
    text = F.to_json(F.struct("verdict", (F.col("refined_id") % 10 / 10).alias("confidence"), F.concat(F.lit("s"), F.col("refined_id").cast("string")).alias("summary"), listed.alias("operations")))
    damage = {
        0: text, 1: F.concat(F.lit("```json\n"), text, F.lit("\n```")), 2: F.concat(F.lit("Sure, here it is: "), text, F.lit(" Hope this {helps}.")), 3: F.concat(F.lit('<think>{"verdict":"delete"}</think>'), text),
        4: F.regexp_replace(text, r"\]\}$", ",]}"), 5: F.regexp_replace(text, '"(verdict|confidence|summary|operations)":', "$1: "), 6: F.regexp_replace(text, r"\]\}$", ""),
        7: F.concat(F.lit('{"verdict":"keep","confidence":0.5,"summary":"cut","operations":[{"op":"update_field","field":"header","value":"x.h"},{"op":"update_field","field":"description","value":"'), F.col("name")),
        8: F.concat(F.lit("no answer for "), F.col("name")), 9: F.regexp_replace(text, '"verdict":"[a-z]+"', '"verdict":"burn"'), 10: F.regexp_replace(text, '"confidence":[0-9.]+', '"confidence":"abc"'),
        11: F.regexp_replace(text, '"confidence":[0-9.]+', '"confidence":7'),
    }
    return every.select("refined_id", "entity_id", "ord", F.coalesce(*[F.when(F.col("form") == k, v) for k, v in damage.items()]).alias("raw"))


def _edits(spark: SparkSession, d: str) -> DataFrame:
    """The edits of all answers, the last answer of each node."""
    return ops.collected(responses.parsed(_answers(spark, d)))


def _replayed(spark: SparkSession, d: str) -> ops.Replayed:
    return ops.replay(_nodes(spark, d).drop("rec_id", "cross_references"), _edges(spark, d), _edits(spark, d))


def _segmented(spark: SparkSession, d: str) -> DataFrame:
    held = segments.segment_lines(_classified(spark, d))
    return held.select("doc_id", "src", "line_no", F.col("seg").cast("long").alias("seg"), "starts", "bucket", "content")


def _merged(spark: SparkSession, d: str) -> DataFrame:
    e = _entities(spark, d).where("name is not null and doc_id is not null and src is not null")
    rows = e.select("doc_id", "src", "name", "ord", "source_line", F.coalesce("entity_type", F.lit("unknown")).alias("entity_type"), F.nullif("header", F.lit("")).alias("header"), "description", "syntax", "remarks", "parameters", "members", "return_value", "requirements", F.array().cast("array<string>").alias("see_also"))
    m = entities.merged(rows)
    return m.select("doc_id", "src", "name", F.col("ord").alias("first_ord"), "source_line", "entity_type", "header", "description", "syntax", "remarks", F.size(F.coalesce("parameters", F.array().cast(dict(rows.dtypes)["parameters"]))).alias("n_parameters"), F.col("requirements.min_client").alias("min_client"))


def _decided(spark: SparkSession, d: str) -> DataFrame:
    e = _entities(spark, d).where("doc_id is not null and src is not null")
    return quality.decide(e.select("doc_id", "src").distinct(), quality.scores(e))


def _flagship(spark: SparkSession, d: str) -> DataFrame:
    found, _ = extract.entities_of(_lines(spark, d), GENERIC)
    return found.select("doc_id", "src", "ord", "name", "entity_type", "description", F.size("parameters").alias("n_parameters"), F.size("cross_references").alias("n_references"), "confidence", "source_line")


def _parsed(spark: SparkSession, d: str) -> DataFrame:
    fields = ("op", "field", "value", "target", "edge_type", "name", "entity_type", "description", "target_id")
    listed = F.array_join(F.transform("response.operations", lambda o: F.concat_ws("|", *[o[c] for c in fields])), ";")
    return responses.parsed(_answers(spark, d)).select("refined_id", "response.verdict", "response.confidence", "response.summary", listed.alias("operations"))


def _parts(spark: SparkSession, d: str) -> DataFrame:
    e = _entities(spark, d).where("syntax is not null").withColumn("ls", F.split("syntax", "\n"))
    return e.select("rec_id", F.size(fields.parameters(F.col("ls"))).alias("n_parameters"), F.size(fields.members(F.col("ls"))).alias("n_members"), fields.return_value(F.col("ls"))["description"].alias("returns"), fields.requirements(F.col("ls"))["header"].alias("header"))


def _exported(spark: SparkSession, d: str) -> DataFrame:
    small_batches(spark)
    e = _entities(spark, d).where("doc_id is not null and src is not null")
    docs = e.groupBy("doc_id", "src").agg(F.min("source_file").alias("source_file"), F.count("*").cast("int").alias("total_entities")).withColumns({"document_id": F.col("doc_id"), "title": F.lit(""), "domain": F.lit(""), "topic": F.lit(""), "ocr_timestamp": F.lit(""), "headers_referenced": F.array().cast("array<string>")})
    return export.document_json(e, docs, stamp="-").select("doc_id", "src", "content_hash")


def queries() -> dict[str, Query]:
    """One entry per operator or group of operators."""
    q: dict[str, Query] = {
        "extract_entities": _flagship,
        "lines_explode": lambda s, d: lines.explode_lines(table(s, d, "documents").select("doc_id", "text")),
        "noise_lines": lambda s, d: table(s, d, "ocr_lines").where(T.is_noise(F.col("text"))).select("line_id"),
        "title_line": lambda s, d: lines.title(_lines(s, d)),
        "parts_opened": lambda s, d: _lines(s, d).select("line_id", T.part_opened(T.strip(F.col("text"))).alias("p")).where("p is not null").select("line_id", "p.key", "p.rest"),
        "name_candidates": lambda s, d: _lines(s, d).select("line_id", T.name_opened(T.strip(F.col("text")), F.lit(True), GENERIC).alias("n")).where("n is not null").select("line_id", "n.name", "n.rest"),
        "lexicon": lambda s, d: lines.lexicon(_classified(s, d)),
        "segment_lines": _segmented,
        "field_parsers": _parts,
        "infer_type": lambda s, d: _entities(s, d).where("name is not null").select("rec_id", T.infer_type(F.col("name"), F.coalesce("entity_type", F.lit("unknown"))).alias("entity_type")),
        "normalize_type": lambda s, d: _entities(s, d).select("rec_id", T.normalize_type(F.col("entity_type")).alias("entity_type")),
        "clean_text": lambda s, d: _entities(s, d).where("description is not null").select("rec_id", T.clean_text(F.col("description")).alias("cleaned")),
        "truncate_text": lambda s, d: table(s, d, "documents").select("doc_id", T.truncate(F.col("text"), 150).alias("short")),
        "content_hash": lambda s, d: table(s, d, "documents").where("text is not null").select("doc_id", T.short_hash(F.col("text")).alias("content_hash"), F.md5("text").alias("md5")),
        "file_meta": lambda s, d: table(s, d, "ocr_lines").where("file_name is not null").select("file_name").distinct().select("file_name", T.file_meta(F.replace("file_name", F.lit("[OCR]_"), F.lit("[OCR]_windows-"))).alias("m"), T.output_name(F.col("file_name")).alias("output_name")).select("file_name", "m.*", "output_name"),
        "confidence": lambda s, d: _entities(s, d).where("name is not null").select(
            "rec_id", T.confidence(F.col("name"), F.col("description"), F.coalesce("entity_type", F.lit("unknown")), F.col("header"), F.col("syntax"), F.coalesce(F.size("parameters") > 0, F.lit(False)) | F.coalesce(F.size("members") > 0, F.lit(False)), F.col("return_value").isNotNull()).alias("confidence")
        ),
        "quality_scores": lambda s, d: quality.scores(_entities(s, d).where("doc_id is not null and src is not null")),
        "decisions": _decided,
        "merge_names": _merged,
        "self_test": lambda s, d: quality.self_test(_entities(s, d).where("doc_id is not null and src is not null")),
        "index_last_wins": lambda s, d: quality.global_index(_entities(s, d).where("name is not null and source_file is not null").withColumn("source_file", F.concat("source_file", F.lit("#"), F.lpad(F.col("rec_id").cast("string"), 12, "0")))),
        "run_totals": lambda s, d: quality.totals(_decided(s, d), _entities(s, d), _edges(s, d)),
        "reference_edges": lambda s, d: graph.reference_edges(_entities(s, d).where("name is not null")),
        "resolved_references": lambda s, d: entities.cross_references(_entities(s, d).where("name is not null and doc_id is not null and src is not null").withColumn("see_also", F.array().cast("array<string>")), table(s, d, "name_index").where("name is not null")),
        "endpoint_ids": lambda s, d: _linked(s, d).select("edge_no", "source_id", "target_id"),
        "neighbours": lambda s, d: graph.neighbours(_linked(s, d), _nodes(s, d)).select("id", F.col("rank").cast("long").alias("rank"), "other", "name", "entity_type"),
        "graph_stats": lambda s, d: graph.stats(_nodes(s, d), _edges(s, d)),
        "type_counts": lambda s, d: graph.type_counts(_nodes(s, d)),
        "degrees": lambda s, d: graph.degrees(_linked(s, d)),
        "contexts": lambda s, d: graph.contexts(_nodes(s, d), _linked(s, d)).select(
            "id", F.array_join("edges_shown", "\n").alias("edges_shown"), F.array_join(F.transform("neighbours", lambda n: F.concat_ws("|", n["name"], n["entity_type"], n["description"])), "\n").alias("neighbours")
        ),
        "pending_nodes": lambda s, d: refine.pending(_nodes(s, d), _answers(s, d).select(F.col("entity_id").alias("id")), min_confidence=0.7, entity_type="function").select("id", "confidence"),
        "parse_responses": _parsed,
        "edit_counts": lambda s, d: ops.op_counts(_edits(s, d)),
        "replayed_nodes": lambda s, d: _replayed(s, d).nodes.select("id", "name", "entity_type", "description", "header"),
        "replayed_edges": lambda s, d: _replayed(s, d).edges.select("source", "target", "type"),
        "replay_counts": lambda s, d: _replayed(s, d).counts,
        "type_tokens": lambda s, d: _entities(s, d).select("rec_id", F.explode("parameters").alias("p")).select("rec_id", F.explode(F.array_distinct(T.type_tokens(F.col("p.type")))).alias("token")).distinct(),
        "type_edges": lambda s, d: enrich.type_edges(_with_types(s, d), table(s, d, "edges").select("source", "target", F.col("edge_type"), "source_file")),
        "typed_index": lambda s, d: enrich.typed_index(_entities(s, d)),
        "document_hashes": _exported,
    }
    return q


# --- DuckDB statements -------------------------------------------------------------------------------------------

_WS = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g')"


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_NOISE = f"({_strip('coalesce(text, chr(32))')} = '' OR {_strip('text')} IN ({', '.join(map(_text, OCR.noise_lines))}) OR regexp_matches({_strip('text')}, '^(≦{_WS}*[0-9]+{_WS}*≧{_WS}*|[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}{_WS}+[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}{_WS}*)$'))"
_LINES = "(SELECT line_id, file_name AS doc_id, coalesce(src, 't') AS src, line_no, coalesce(text, '') AS text FROM ocr_lines WHERE file_name IS NOT NULL)"
_STOP = f"({{n}} IN ({', '.join(map(_text, OCR.stop_words))}))"
_END = rf"({_WS}|$|[\x{{4e00}}-\x{{9fff}}])"
_NAMES = f"""(SELECT *, CASE
    WHEN length(caps) >= 6 AND NOT regexp_matches(substr(s, length(caps) + 1, 1), '[a-z]') THEN caps
    WHEN regexp_matches(s, '^_[a-zA-Z][a-zA-Z0-9]+{_END}') THEN regexp_extract(s, '^(_[a-zA-Z][a-zA-Z0-9]+)', 1)
    WHEN regexp_matches(s, '^[A-Za-z_][A-Za-z0-9_]+{_WS}*\\(') AND length(call) >= 4 AND NOT {_STOP.format(n="call")} THEN call
    WHEN regexp_matches(s, '^[A-Z][a-z][a-zA-Z0-9]*{_END}') AND length(camel) >= 4 AND NOT {_STOP.format(n="camel")} THEN camel END AS name,
    CASE WHEN length(caps) >= 6 AND NOT regexp_matches(substr(s, length(caps) + 1, 1), '[a-z]') THEN length(caps)
    WHEN regexp_matches(s, '^_[a-zA-Z][a-zA-Z0-9]+{_END}') THEN length(regexp_extract(s, '^(_[a-zA-Z][a-zA-Z0-9]+)', 1))
    WHEN regexp_matches(s, '^[A-Za-z_][A-Za-z0-9_]+{_WS}*\\(') AND length(call) >= 4 AND NOT {_STOP.format(n="call")} THEN length(regexp_extract(s, '^[A-Za-z_][A-Za-z0-9_]+{_WS}*\\('))
    ELSE length(camel) END AS used
    FROM (SELECT *, regexp_extract(s, '^([A-Z][A-Z0-9]*(?:_[A-Z0-9]+)+)', 1) AS caps, regexp_extract(s, '^([A-Za-z_][A-Za-z0-9_]+)', 1) AS call, regexp_extract(s, '^([A-Z][a-z][a-zA-Z0-9]*)', 1) AS camel
        FROM (SELECT *, {_strip("text")} AS s FROM {_LINES})))"""


def _opened() -> str:
    tests, keys, rests = [], [], []
    for marker, key in OCR.parts:
        rest = _strip(f"substr(s, {len(marker) + 1})")
        cond = f"(s = {_text(marker)} OR (starts_with(s, {_text(marker)}) AND regexp_matches({rest}, '^[\\[（(：:类返无没\\p{{Lu}}]')))"
        tests.append(cond)
        keys.append(f"WHEN {cond} THEN '{key}'")
        rests.append(f"WHEN {cond} THEN {rest}")
    return f"SELECT line_id, CASE {' '.join(keys)} END AS key, CASE {' '.join(rests)} END AS rest FROM (SELECT line_id, {_strip('text')} AS s FROM {_LINES}) WHERE {' OR '.join(tests)}"


def _cleaned(c: str) -> str:
    c = f"regexp_replace({c}, {_text(OCR.text_noise.replace('(?U)', '').replace(chr(92) + 's', _WS))}, '', 'g')"
    for end in OCR.text_ends:
        c = f"regexp_replace({c}, {_text(end.replace(chr(92) + 's', _WS))}, '')"
    trail = rf"^(.*?[。.]){_WS}+[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)+{_WS}*$"
    c = f"regexp_replace({c}, '{trail}', '\\1', 's')"
    c = f"regexp_replace({_strip(f'regexp_replace({c}, {_text(_WS + chr(43))}, chr(32), {_text(chr(103))})')}, '^[- ：:]+', '')"
    return f"regexp_replace({c}, '{_WS}+是{_WS}+否{_WS}*$', '')"


_ENT = "(SELECT *, document_id AS doc_id, entity_id AS id, rec_id AS ord FROM entities)"
_NODE = "(SELECT name, 'windows::' || name AS id, entity_type, description, header, confidence FROM entities WHERE name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY name ORDER BY rec_id DESC) = 1)"
_EDGE = "(SELECT edge_id AS edge_no, source, target, coalesce(edge_type, 'unknown') AS type, source_file FROM edges WHERE source IS NOT NULL AND target IS NOT NULL AND target <> '')"
_LINK = "(SELECT *, 'windows::' || source AS source_id, 'windows::' || target AS target_id FROM " + _EDGE + ")"
_NORMAL = f"CASE WHEN coalesce({{t}}, '') = '' THEN 'unknown' WHEN {{t}} IN ('struct', 'structure') THEN 'structure' WHEN {{t}} = 'enumvalue' THEN 'enum_value' WHEN {{t}} IN ({', '.join(map(_text, KNOWN_TYPES))}) THEN {{t}} ELSE 'unknown' END"
_TYPE = _NORMAL.format(t=f"lower({_strip('coalesce(entity_type, chr(32))')})")
_HAS = {"syntax": "coalesce(syntax <> '', false)", "parameters": "coalesce(len(parameters) > 0, false)", "members": "coalesce(len(members) > 0, false)", "return_value": "return_value IS NOT NULL", "remarks": "coalesce(remarks <> '', false)", "requirements": "requirements IS NOT NULL", "header": "coalesce(header <> '', false)"}
_SCORES = f"""(SELECT *, round_even(0.10 * least(total / 20.0, 1.0) + 0.20 * a + 0.15 * ty + 0.20 * fc + 0.15 * least(dl / 100.0, 1.0) + 0.10 * sy - 0.10 * no, 6) AS score FROM (
    SELECT doc_id, src, CAST(count(*) AS INTEGER) AS total, avg(coalesce(confidence, 0)) AS a, avg(CASE WHEN coalesce(entity_type, 'unknown') <> 'unknown' THEN 1.0 ELSE 0.0 END) AS ty,
    sum({' + '.join(f'CASE WHEN {_HAS[k]} THEN {w} ELSE 0 END' for k, w in quality.FIELD_WEIGHTS.items())}) / (count(*) * 8.5) AS fc, avg(length(coalesce(description, ''))) AS dl,
    sum(CASE WHEN regexp_matches(coalesce(description, ''), '{'|'.join(OCR.noise_tokens)}') THEN 1 ELSE 0 END + CASE WHEN regexp_matches(coalesce(description, ''), 'ﾉ|展开表') THEN 1 ELSE 0 END) / (count(*) * 2.0) AS no,
    avg(CASE WHEN {_HAS['syntax']} THEN 1.0 ELSE 0.0 END) AS sy FROM {_ENT} WHERE doc_id IS NOT NULL AND src IS NOT NULL GROUP BY doc_id, src))"""
_DECIDED_SQL = f"""SELECT coalesce(p.doc_id, t.doc_id) AS doc_id, CASE WHEN t.score IS NULL THEN 'only_p' WHEN p.score IS NULL THEN 'only_t' WHEN p.score = t.score THEN printf('identical (score=%.4f)', p.score)
    WHEN p.score - t.score >= 0.005 THEN printf('heuristic_p (p=%.3f t=%.3f)', p.score, t.score) WHEN t.score - p.score >= 0.005 THEN printf('heuristic_t (p=%.3f t=%.3f)', p.score, t.score) ELSE 'llm_pending' END AS decision,
    CASE WHEN p.score IS NULL OR t.score - p.score >= 0.005 THEN 't' ELSE 'p' END AS winner, p.score AS p_score, t.score AS t_score
    FROM (SELECT * FROM {_SCORES} WHERE src = 'p') p FULL OUTER JOIN (SELECT * FROM {_SCORES} WHERE src = 't') t ON p.doc_id = t.doc_id"""
_ANSWER = """(WITH r AS (SELECT refined_id, name, entity_type, coalesce(description, '') AS description FROM refined WHERE name IS NOT NULL),
    k AS (SELECT source AS name, min(target) AS linked FROM edges WHERE target <> '' GROUP BY source),
    a AS (SELECT r.*, coalesce(x.name, r.name) AS other, linked FROM r LEFT JOIN r x ON x.refined_id = r.refined_id + CASE WHEN r.refined_id % 14 = 6 THEN 7 ELSE 1 END LEFT JOIN k ON k.name = r.name)
    SELECT refined_id, name, CASE WHEN refined_id % 12 = 8 THEN 'keep' WHEN refined_id % 12 IN (7, 9) OR refined_id % 7 < 5 THEN 'keep' WHEN refined_id % 7 = 5 THEN 'delete' ELSE 'merge' END AS verdict,
    CASE refined_id % 12 WHEN 7 THEN 0.5 WHEN 8 THEN 0.0 WHEN 10 THEN 0.5 WHEN 11 THEN 1.0 ELSE (refined_id % 10) / 10.0 END AS confidence,
    CASE refined_id % 12 WHEN 7 THEN 'cut' WHEN 8 THEN '解析失败' ELSE 's' || refined_id END AS summary,
    CASE WHEN refined_id % 12 = 7 THEN [{'op': 'update_field', 'field': 'header', 'value': 'x.h', 'target': NULL, 'edge_type': NULL, 'name': NULL, 'entity_type': NULL, 'description': NULL, 'target_id': NULL}] WHEN refined_id % 12 = 8 THEN []
    ELSE CASE refined_id % 7
        WHEN 0 THEN [{'op': 'update_field', 'field': (['description', 'header', 'color'])[refined_id % 3 + 1], 'value': description, 'target': NULL, 'edge_type': NULL, 'name': NULL, 'entity_type': NULL, 'description': NULL, 'target_id': NULL},
            {'op': 'add_edge', 'field': NULL, 'value': NULL, 'target': other, 'edge_type': 'uses', 'name': NULL, 'entity_type': NULL, 'description': NULL, 'target_id': NULL}]
        WHEN 1 THEN [{'op': 'add_edge', 'field': NULL, 'value': NULL, 'target': other, 'edge_type': 'uses', 'name': NULL, 'entity_type': NULL, 'description': NULL, 'target_id': NULL}]
        WHEN 2 THEN [{'op': 'delete_edge', 'field': NULL, 'value': NULL, 'target': coalesce(linked, other), 'edge_type': CASE WHEN refined_id % 2 = 1 THEN 'references' END, 'name': NULL, 'entity_type': NULL, 'description': NULL, 'target_id': NULL}]
        WHEN 3 THEN [{'op': 'add_node', 'field': NULL, 'value': NULL, 'target': NULL, 'edge_type': NULL, 'name': name || '_NEW', 'entity_type': entity_type, 'description': description, 'target_id': NULL}]
        WHEN 4 THEN [{'op': 'update_field', 'field': 'entity_type', 'value': 'enum', 'target': NULL, 'edge_type': NULL, 'name': NULL, 'entity_type': NULL, 'description': NULL, 'target_id': NULL}]
        WHEN 6 THEN [{'op': 'merge_into', 'field': NULL, 'value': NULL, 'target': NULL, 'edge_type': NULL, 'name': NULL, 'entity_type': NULL, 'description': NULL, 'target_id': 'windows::' || other}] ELSE [] END END AS ops FROM a)"""
_LOG = f"""la AS MATERIALIZED (SELECT * FROM {_ANSWER} QUALIFY row_number() OVER (PARTITION BY name ORDER BY refined_id DESC) = 1),
    o AS MATERIALIZED (SELECT refined_id * 10 + i AS seq, 'windows::' || name AS entity_id, u.op, u.field, u.value, u.target, u.edge_type, u.name AS new_name, u.entity_type, u.description, u.target_id
        FROM (SELECT refined_id, name, unnest(ops) AS u, unnest(range(1, len(ops) + 1)) AS i FROM la) UNION ALL
        SELECT refined_id * 10, 'windows::' || name, 'delete_node', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM la WHERE verdict = 'delete')"""
_RULES = """WHEN starts_with(name, 'IOCTL_') OR starts_with(name, 'FSCTL_') THEN 'ioctl'
    WHEN regexp_matches(name, '^(GUID|CLSID|IID|DEVPKEY|PKEY|WM|WS|ERROR|STATUS|FLAG|DXGI)_') THEN 'constant' WHEN regexp_matches(name, '_FLAGS?$') THEN 'enum' WHEN regexp_matches(name, '^(KSPROPERTY|SENSOR)_') THEN 'constant'
    WHEN regexp_matches(name, '^(EVT|PFN)_|(_CALLBACK|_ROUTINE|_HANDLER|Callback)$') THEN 'callback' WHEN regexp_matches(name, '^_?[A-Z][a-z].*(Ex|ExW|A|W)$') THEN 'function' WHEN regexp_matches(name, '^I[A-Z][a-z]') THEN 'interface'"""


_SHORT = f"(SELECT CASE WHEN length(t) > 150 THEN substr(t, 1, 150) || '...' ELSE t END FROM (SELECT {_strip("replace(coalesce(n.description, ''), chr(10), chr(32))")} AS t))"


def _tokens(c: str) -> str:
    spaced = f"regexp_replace(coalesce({c}, ''), '[\\s*]+', ' ', 'g')"
    words = f"string_split_regex({_strip(f'replace({spaced}, chr(44), chr(32))')}, '\\s+')"
    bare = f"list_transform({words}, lambda w: regexp_replace(w, '^[()\\[\\]{{}};]+|[()\\[\\]{{}};]+$', '', 'g'))"
    return f"list_filter({bare}, lambda w: regexp_matches(w, '^[A-Za-z_][A-Za-z0-9_]*$') AND lower(w) NOT IN ({', '.join(map(_text, TYPE_WORDS))}))"


def oracle_sql() -> dict[str, str]:
    """DuckDB statements for the queries that SQL can express."""
    neighbour = f"""WITH adj AS (SELECT DISTINCT * FROM (SELECT source_id AS id, target_id AS other FROM {_LINK} UNION ALL SELECT target_id, source_id FROM {_LINK}))
        SELECT a.id, row_number() OVER (PARTITION BY a.id ORDER BY n.name IS NULL, a.other) AS rank, a.other, coalesce(n.name, substr(a.other, 10)) AS name,
        CASE WHEN n.name IS NULL THEN 'external_ref' ELSE coalesce(n.entity_type, 'unknown') END AS entity_type FROM adj a LEFT JOIN {_NODE} n ON n.id = a.other QUALIFY rank <= 15"""
    classified = f"""c AS (SELECT n.*, CASE {' '.join(f"WHEN s = {_text(m)} OR (starts_with(s, {_text(m)}) AND regexp_matches({_strip(f'substr(s, {len(m) + 1})')}, '^[\\[（(：:类返无没\\p{{Lu}}]')) THEN '{k}'" for m, k in OCR.parts)} END AS start_key
        FROM {_NAMES} n WHERE NOT {_NOISE})"""
    return {
        "lines_explode": "SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, l[i] AS text FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(regexp_replace(text, '\\r\\n?', chr(10), 'g'), chr(10)) AS l FROM documents WHERE text IS NOT NULL))",
        "noise_lines": f"SELECT line_id FROM ocr_lines WHERE {_NOISE}",
        "title_line": f"SELECT doc_id, src, arg_min(t, line_no) AS title FROM (SELECT doc_id, src, line_no, {_strip(f'regexp_replace({_strip("text")}, {_text("项目" + _WS + "*[0-9]{4}/[0-9]{2}/[0-9]{2}")}, {_text("")}, {_text("g")})')} AS t FROM {_LINES} WHERE line_no < 20 AND NOT {_NOISE} AND NOT starts_with({_strip('text')}, '[OCR]')) WHERE t <> '' GROUP BY doc_id, src",
        "parts_opened": _opened(),
        "name_candidates": f"SELECT line_id, name, {_strip('substr(s, used + 1)')} AS rest FROM {_NAMES} WHERE name IS NOT NULL",
        "lexicon": f"SELECT DISTINCT name FROM {_NAMES} WHERE name IS NOT NULL AND NOT {_NOISE}",
        "infer_type": f"SELECT rec_id, CASE WHEN coalesce(entity_type, 'unknown') <> 'unknown' THEN entity_type {_RULES} ELSE 'unknown' END AS entity_type FROM entities WHERE name IS NOT NULL",
        "normalize_type": f"SELECT rec_id, {_TYPE} AS entity_type FROM entities",
        "clean_text": f"SELECT rec_id, {_cleaned('description')} AS cleaned FROM entities WHERE description IS NOT NULL",
        "truncate_text": f"SELECT doc_id, CASE WHEN length(t) > 150 THEN substr(t, 1, 150) || '...' ELSE t END AS short FROM (SELECT doc_id, {_strip(f'replace(coalesce(text, {_text("")}), chr(10), chr(32))')} AS t FROM documents)",
        "content_hash": "SELECT doc_id, substr(sha256(text), 1, 12) AS content_hash, md5(text) AS md5 FROM documents WHERE text IS NOT NULL",
        "confidence": rf"""SELECT rec_id, least(100, CASE WHEN regexp_matches(name, '^[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)+$') THEN 30 WHEN starts_with(name, '_') THEN 20 WHEN regexp_matches(name, '^[A-Z][a-z]') THEN 15 ELSE 0 END
            + CASE WHEN length(coalesce(description, '')) > 50 THEN 20 WHEN length(coalesce(description, '')) > 20 THEN 10 ELSE 0 END + CASE WHEN coalesce(entity_type, 'unknown') <> 'unknown' THEN 15 ELSE 0 END
            + CASE WHEN {_HAS['header']} THEN 10 ELSE 0 END + CASE WHEN {_HAS['syntax']} THEN 10 ELSE 0 END + CASE WHEN {_HAS['parameters']} OR {_HAS['members']} THEN 10 ELSE 0 END
            + CASE WHEN return_value IS NOT NULL THEN 5 ELSE 0 END) / 100.0 AS confidence FROM entities WHERE name IS NOT NULL""",
        "quality_scores": f"SELECT doc_id, src, total, round_even(a, 4) AS avg_conf, round_even(ty, 4) AS typed_ratio, round_even(fc, 4) AS field_coverage, round_even(dl, 1) AS avg_desc_len, round_even(no, 4) AS noise_ratio, round_even(sy, 4) AS syntax_ratio, score FROM {_SCORES}",
        "merge_names": f"""SELECT doc_id, src, name, min(ord) AS first_ord, arg_min(source_line, ord) AS source_line, coalesce(arg_min(entity_type, ord) FILTER (WHERE coalesce(entity_type, 'unknown') <> 'unknown'), 'unknown') AS entity_type,
            arg_min(header, ord) FILTER (WHERE header <> '') AS header, first(description ORDER BY coalesce(length(description), -1) DESC, ord) AS description, first(syntax ORDER BY coalesce(length(syntax), -1) DESC, ord) AS syntax,
            first(remarks ORDER BY coalesce(length(remarks), -1) DESC, ord) AS remarks, CAST(max(coalesce(len(parameters), 0)) AS INTEGER) AS n_parameters, arg_max(requirements.min_client, ord) FILTER (WHERE requirements.min_client IS NOT NULL) AS min_client
            FROM {_ENT} WHERE name IS NOT NULL AND doc_id IS NOT NULL AND src IS NOT NULL GROUP BY doc_id, src, name""",
        "index_last_wins": "SELECT name, entity_id AS id, source_file || '#' || lpad(CAST(rec_id AS VARCHAR), 12, '0') AS file, entity_type AS type FROM entities WHERE name IS NOT NULL AND source_file IS NOT NULL QUALIFY row_number() OVER (PARTITION BY name ORDER BY source_file || '#' || lpad(CAST(rec_id AS VARCHAR), 12, '0') DESC) = 1",
        "reference_edges": "SELECT name AS source, unnest(cross_references) AS target, 'references' AS type, source_file FROM entities WHERE name IS NOT NULL",
        "endpoint_ids": f"SELECT edge_no, source_id, target_id FROM {_LINK}",
        "neighbours": neighbour,
        "graph_stats": f"SELECT v AS total_entities, e AS total_edges, round_even(2.0 * e / greatest(v, 1), 2) AS avg_degree FROM (SELECT (SELECT count(*) FROM {_NODE}) AS v, (SELECT count(*) FROM {_EDGE}) AS e)",
        "type_counts": f"SELECT coalesce(entity_type, 'unknown') AS entity_type, count(*) AS n FROM {_NODE} GROUP BY 1",
        "degrees": f"SELECT id, count(*) AS degree FROM (SELECT source_id AS id FROM {_LINK} UNION ALL SELECT target_id FROM {_LINK}) GROUP BY id",
        "pending_nodes": f"SELECT id, confidence FROM {_NODE} WHERE id NOT IN (SELECT 'windows::' || name FROM refined WHERE name IS NOT NULL) AND coalesce(confidence, 1.0) <= 0.7 AND coalesce(entity_type, 'unknown') = 'function'",
        "contexts": f"""WITH n AS MATERIALIZED (SELECT * FROM {_NODE}), l AS MATERIALIZED (SELECT id, source || ' --[' || type || ']--> ' || target AS line FROM (SELECT *, source_id AS id FROM {_LINK} UNION ALL SELECT *, target_id FROM {_LINK} WHERE source_id <> target_id)),
            e AS (SELECT id, string_agg(DISTINCT line, chr(10) ORDER BY line) AS edges_shown FROM (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY id ORDER BY line) <= 25) GROUP BY id),
            b AS (SELECT x.id, x.rank, concat_ws('|', x.name, x.entity_type, CASE WHEN n.id IS NULL THEN '(未在图谱中)' ELSE {_SHORT} END) AS line FROM ({neighbour}) x LEFT JOIN n ON n.id = x.other),
            g AS (SELECT id, string_agg(line, chr(10) ORDER BY rank) AS neighbours FROM b GROUP BY id)
            SELECT n.id, edges_shown, neighbours FROM n LEFT JOIN e ON e.id = n.id LEFT JOIN g ON g.id = n.id""",
        "type_edges": f"""WITH e AS (SELECT name, entity_type, parameters, return_value.type AS rt, source_file FROM entities UNION ALL SELECT unnest(['PVOID', 'SIZE_T', 'UINT64', 'BYTE', 'ULONG', 'UINT32', 'INT16', 'WCHAR', 'HANDLE', 'DWORD']), 'Typedef ', NULL, NULL, 'types.json'),
            t AS (SELECT DISTINCT name FROM (SELECT name, {_TYPE} AS ty FROM e WHERE name <> '') WHERE ty IN ('structure', 'struct', 'enum', 'enum_value', 'union', 'typedef', 'constant', 'macro', 'flags', 'error_code')),
            f AS (SELECT * FROM e WHERE name <> '' AND {_TYPE} = 'function'),
            u AS (SELECT name AS source, source_file, unnest({_tokens('p.type')}) AS token, ['parameter_type', 'uses'] AS kinds FROM (SELECT name, source_file, unnest(parameters) AS p FROM f)
                UNION ALL SELECT name, source_file, unnest({_tokens('rt')}), ['return_type', 'returns'] FROM f),
            w AS (SELECT source, source_file, token AS target, unnest(kinds) AS type FROM u WHERE token IN (SELECT name FROM t)),
            h AS (SELECT DISTINCT least(source, target) AS lo, greatest(source, target) AS hi, coalesce(edge_type, 'unknown') AS type FROM edges WHERE source <> '' AND target <> '')
            SELECT source, target, type, source_file FROM (SELECT *, least(source, target) AS lo, greatest(source, target) AS hi FROM w) w WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.lo = w.lo AND h.hi = w.hi AND h.type = w.type)
            QUALIFY row_number() OVER (PARTITION BY lo, hi, type ORDER BY source_file NULLS FIRST, source, target) = 1""",
        "edit_counts": f"WITH {_LOG} SELECT op, count(*) AS n FROM o GROUP BY op",
        "decisions": _DECIDED_SQL,
        "run_totals": f"SELECT (SELECT count(*) FROM ({_DECIDED_SQL})) AS total_pairs, (SELECT count(*) FROM ({_DECIDED_SQL}) WHERE starts_with(decision, 'llm')) AS llm_compares, (SELECT count(*) FROM entities) AS total_entities, (SELECT count(*) FROM {_EDGE}) AS total_edges",
        "self_test": f"""SELECT e.doc_id, e.src, sum(CASE WHEN coalesce(id, '') = '' THEN 1 ELSE 0 END + CASE WHEN coalesce(name, '') = '' THEN 1 ELSE 0 END + CASE WHEN coalesce(entity_type, '') = '' THEN 1 ELSE 0 END + CASE WHEN coalesce(description, '') = '' THEN 1 ELSE 0 END + CASE WHEN confidence IS NULL THEN 1 ELSE 0 END) AS missing_fields,
            sum(CASE WHEN regexp_matches(coalesce(description, ''), '{'|'.join(OCR.noise_tokens)}') THEN 1 ELSE 0 END) AS noisy_texts, sum(CASE WHEN entity_type IS NULL THEN NULL WHEN entity_type IN ({', '.join(map(_text, EXTRACTED_TYPES))}) THEN 0 ELSE 1 END) AS invalid_types,
            sum(CASE WHEN confidence IS NULL THEN NULL WHEN confidence BETWEEN 0 AND 1 THEN 0 ELSE 1 END) AS bad_confidence, avg(CASE WHEN entity_type IS NULL THEN NULL WHEN entity_type = 'unknown' THEN 1.0 ELSE 0.0 END) > 0.3 AS mostly_unknown, any_value(d.n) AS duplicate_ids
            FROM {_ENT} e JOIN (SELECT doc_id, src, sum(c - 1) AS n FROM (SELECT doc_id, src, id, count(*) AS c FROM {_ENT} GROUP BY doc_id, src, id) GROUP BY doc_id, src) d ON e.doc_id = d.doc_id AND e.src = d.src GROUP BY e.doc_id, e.src""",
        "file_meta": r"""SELECT file_name, CASE WHEN NOT ok THEN '' WHEN len(pieces) = 2 THEN pieces[1] WHEN contains(raw, '-') THEN regexp_extract(raw, '^(.*)-[^-]*$', 1) ELSE raw END AS domain,
            CASE WHEN NOT ok THEN '' WHEN len(pieces) = 2 THEN pieces[2] WHEN contains(raw, '-') THEN regexp_extract(raw, '-([^-]*)$', 1) ELSE '' END AS topic,
            CASE WHEN ok THEN regexp_replace(regexp_extract(f, p), p, '\2-\3-\4T\5:\6:00') ELSE '' END AS ocr_time, replace(replace(replace(file_name, '[OCR]_windows-', ''), '.p.txt', ''), '.txt', '') || '.json' AS output_name
            FROM (SELECT *, regexp_matches(f, p) AS ok, regexp_extract(f, p, 1) AS raw, string_split(regexp_extract(f, p, 1), '-_') AS pieces FROM (
            SELECT DISTINCT file_name, replace(file_name, '[OCR]_', '[OCR]_windows-') AS f, '^\[OCR\]_windows-(.+?)_([0-9]{4})([0-9]{2})([0-9]{2})_([0-9]{2})([0-9]{2})' AS p FROM ocr_lines WHERE file_name IS NOT NULL))""",
        "resolved_references": rf"""WITH e AS (SELECT document_id AS doc_id, src, name, concat_ws(' ', description, remarks) AS t FROM entities WHERE name IS NOT NULL AND document_id IS NOT NULL AND src IS NOT NULL),
            r AS (SELECT DISTINCT doc_id, src, name, unnest(list_filter(string_split_regex(t, '[^\p{{L}}\p{{M}}\p{{N}}\p{{Pc}}\x{{200c}}\x{{200d}}]+'), lambda w: regexp_full_match(w, '[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)+') OR (regexp_full_match(w, '[A-Z][a-z][a-zA-Z0-9]{{2,}}') AND NOT {_STOP.format(n="w")}))) AS ref FROM e)
            SELECT doc_id, src, name, list_sort(list(DISTINCT ref)) AS cross_references FROM r WHERE ref <> name AND (ref IN (SELECT name FROM name_index WHERE name IS NOT NULL) OR (doc_id, src, ref) IN (SELECT doc_id, src, name FROM e)) GROUP BY doc_id, src, name""",
        "parse_responses": f"SELECT refined_id, verdict, CAST(confidence AS DOUBLE) AS confidence, summary, coalesce(list_aggregate(list_transform(ops, lambda x: concat_ws('|', x.op, x.field, x.value, x.target, x.edge_type, x.name, x.entity_type, x.description, x.target_id)), 'string_agg', ';'), '') AS operations FROM {_ANSWER}",
        "replayed_nodes": f"""WITH RECURSIVE n AS MATERIALIZED (SELECT * FROM {_NODE}), {_LOG},
            d AS (SELECT DISTINCT entity_id AS id FROM o WHERE op = 'delete_node'), m AS (SELECT entity_id AS id, target_id AS goal, seq FROM o WHERE op = 'merge_into' AND target_id IN (SELECT id FROM n)),
            c AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY seq) AS k FROM (SELECT entity_id AS id, NULL AS goal, min(seq) AS seq FROM o WHERE op = 'delete_node' AND entity_id NOT IN (SELECT id FROM m) GROUP BY entity_id
                UNION ALL SELECT id, goal, seq FROM m WHERE id NOT IN (SELECT id FROM d)) WHERE id IN (SELECT id FROM n)),
            g AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS VARCHAR[]) AS gone UNION ALL SELECT c.k, CASE WHEN c.goal IS NULL OR NOT list_contains(gone, c.goal) THEN list_append(gone, c.id) ELSE gone END FROM g JOIN c ON c.k = g.k + 1),
            done AS MATERIALIZED (SELECT c.id, c.goal, c.seq FROM c JOIN g ON g.k = c.k - 1 WHERE c.goal IS NULL OR NOT list_contains(g.gone, c.goal)),
            p AS (SELECT id, goal, seq, [seq] AS times FROM done WHERE goal <> id UNION ALL SELECT p.id, done.goal, done.seq, list_prepend(done.seq, p.times) FROM p JOIN done ON done.id = p.goal WHERE done.goal <> done.id),
            f AS (SELECT p.goal AS id, arg_min(n.description, times) FILTER (WHERE n.description <> '') AS description, arg_min(n.header, times) FILTER (WHERE n.header <> '') AS header FROM p JOIN n ON n.id = p.id GROUP BY p.goal),
            q AS (SELECT * FROM o WHERE entity_id NOT IN (SELECT id FROM d) AND entity_id NOT IN (SELECT id FROM m)),
            u AS (SELECT entity_id, field, value AS v FROM q WHERE op = 'update_field'),
            a AS (SELECT 'windows::' || new_name AS id, arg_min(new_name, seq) AS name, arg_min_null(entity_type, seq) AS entity_type, arg_min_null(description, seq) AS description FROM q
                WHERE op = 'add_node' AND ('windows::' || new_name NOT IN (SELECT id FROM n) OR EXISTS (SELECT 1 FROM done WHERE done.id = 'windows::' || new_name AND done.seq < q.seq)) GROUP BY 1)
            SELECT n.id, n.name, CASE WHEN z.entity_id IS NOT NULL THEN z.v ELSE n.entity_type END AS entity_type, coalesce(nullif(CASE WHEN x.entity_id IS NOT NULL THEN x.v ELSE n.description END, ''), f.description, CASE WHEN x.entity_id IS NOT NULL THEN x.v ELSE n.description END) AS description,
                coalesce(nullif(CASE WHEN y.entity_id IS NOT NULL THEN y.v ELSE n.header END, ''), f.header, CASE WHEN y.entity_id IS NOT NULL THEN y.v ELSE n.header END) AS header
            FROM n LEFT JOIN u x ON x.entity_id = n.id AND x.field = 'description' LEFT JOIN u y ON y.entity_id = n.id AND y.field = 'header' LEFT JOIN u z ON z.entity_id = n.id AND z.field = 'entity_type' LEFT JOIN f ON f.id = n.id
            WHERE n.id NOT IN (SELECT id FROM done) UNION ALL SELECT id, name, coalesce(entity_type, 'unknown'), description, NULL FROM a""",
        "type_tokens": f"SELECT DISTINCT rec_id, unnest({_tokens('p.type')}) AS token FROM (SELECT rec_id, unnest(parameters) AS p FROM entities)",
        "typed_index": f"SELECT entity_id AS id, name, {_TYPE} AS entity_type FROM entities WHERE entity_id <> '' AND name <> ''",
        "segment_lines": f"""WITH {classified},
            o AS (SELECT *, coalesce(max(CASE WHEN name IS NOT NULL THEN 1 ELSE 0 END) OVER w = 1, false) AS open FROM c WINDOW w AS (PARTITION BY doc_id, src ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
            e AS (SELECT *, regexp_extract(s, '^(.*?[。.!）)]){_WS}*(注解|备注|言论|语法 C\\+\\+|语法|参数|返回值|成员|要求|另请参阅){_WS}*$', 2) AS end_word, {_strip(f"regexp_extract(s, {_text('^(.*?[。.!）)])' + _WS + '*(注解|备注|言论|语法 C' + chr(92) + '+' + chr(92) + '+|语法|参数|返回值|成员|要求|另请参阅)' + _WS + '*$')}, 1)")} AS end_before FROM o),
            m AS (SELECT *, CASE WHEN end_word <> '' THEN CASE end_word {' '.join(f"WHEN {_text(a)} THEN '{b}'" for a, b in OCR.parts)} END ELSE start_key END AS key FROM e),
            t AS (SELECT *, name IS NOT NULL AND NOT (key IS NOT NULL AND open) AS starts FROM m),
            g AS (SELECT *, sum(CASE WHEN starts THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, src ORDER BY line_no) AS seg FROM t),
            h AS (SELECT * FROM g WHERE open OR starts),
            b AS (SELECT *, coalesce(last_value(CASE WHEN NOT starts THEN key END IGNORE NULLS) OVER (PARTITION BY doc_id, src, seg ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'description') AS before FROM h)
            SELECT doc_id, src, line_no, CAST(seg AS BIGINT) AS seg, starts, CASE WHEN starts THEN 'description' WHEN end_word = '' AND start_key IS NOT NULL THEN start_key ELSE before END AS bucket,
            CASE WHEN starts THEN {_strip('substr(s, used + 1)')} WHEN end_word <> '' THEN end_before WHEN start_key IS NOT NULL THEN CASE {' '.join(f"WHEN s = {_text(a)} OR (starts_with(s, {_text(a)}) AND regexp_matches({_strip(f'substr(s, {len(a) + 1})')}, '^[\\[（(：:类返无没\\p{{Lu}}]')) THEN {_strip(f'substr(s, {len(a) + 1})')}" for a, b in OCR.parts)} END ELSE s END AS content FROM b""",
    }
