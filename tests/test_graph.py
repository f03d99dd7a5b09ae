"""Graph, edits, answers, enrichment and documents."""

import json
import random

from pyspark.sql import functions as F

from graphloom.operators import enrich, graph, ops, responses
from graphloom.plans import refine
from graphloom.sinks import export
from graphloom.sources import documents, reviewer, text
from graphloom.streaming import incremental

NODE = "id string, name string, entity_type string, description string, header string, cross_references array<string>, confidence double, source_file string"
EDGE = "edge_no long, source string, target string, type string, source_file string"
OPS = "seq long, entity_id string, op string, field string, value string, target string, edge_type string, name string, entity_type string, description string, reason string, target_id string"


def nodes(spark, names, **more):
    return spark.createDataFrame([(f"windows::{n}", n, more.get("t", "function"), f"text {n}", None, [], 0.5, "f.json") for n in names], NODE)


def edits(spark, rows):
    keys = [c.split()[0] for c in OPS.split(", ")]
    return spark.createDataFrame([tuple((r | {"seq": i}).get(k) for k in keys) for i, r in enumerate(rows)], OPS)


def test_neighbours_and_stats(spark):
    n = nodes(spark, ["A", "B", "C"])
    e = spark.createDataFrame([(1, "A", "B", "references", "f"), (2, "B", "A", "uses", "f"), (3, "A", "X", "references", "f"), (4, "C", "C", "references", "f")], EDGE)
    linked = graph.endpoint_ids(e, n)
    near = {(r.id, r.rank, r.name, r.entity_type) for r in graph.neighbours(linked, n).collect()}
    assert near == {("windows::A", 1, "B", "function"), ("windows::A", 2, "X", "external_ref"), ("windows::B", 1, "A", "function"), ("windows::X", 1, "A", "function"), ("windows::C", 1, "C", "function")}
    assert graph.stats(n, e).collect()[0].asDict() == {"total_entities": 3, "total_edges": 4, "avg_degree": 2.67}
    assert {r.id: r.degree for r in graph.degrees(linked).collect()} == {"windows::A": 3, "windows::B": 2, "windows::X": 1, "windows::C": 2}
    assert graph.stats(n.limit(0), e.limit(0)).collect()[0].avg_degree == 0
    shown = {r.id: r for r in graph.contexts(n, linked).collect()}
    assert len(shown["windows::A"].edges_shown) == 3 and "text A" in graph.prompt(shown["windows::A"].entity, shown["windows::A"].edges_shown, [x.asDict() for x in shown["windows::A"].neighbours])


def test_hub_shows_only_its_first_neighbours(spark):
    e = spark.range(200).select(F.col("id").alias("edge_no"), F.lit("HUB").alias("source"), F.format_string("N%03d", "id").alias("target"), F.lit("references").alias("type"), F.lit("f").alias("source_file"))
    near = graph.neighbours(graph.endpoint_ids(e, nodes(spark, ["HUB", "N150"])), nodes(spark, ["HUB", "N150"])).where("id = 'windows::HUB'").orderBy("rank").collect()
    assert [r.name for r in near] == ["N150", *[f"N{i:03d}" for i in range(14)]]


def sequential(names, edges, log):
    """The edits one after another, by their definition, with strict edges."""
    node = {f"windows::{n}": {"name": n, "description": f"text {n}", "header": None} for n in names}
    first, edges = dict(node), [list(e) for e in edges]
    deletes = {o["entity_id"] for o in log if o["op"] == "delete_node"}
    merges = {o["entity_id"] for o in log if o["op"] == "merge_into" and o.get("target_id") in first}
    lost, done = set(), []
    for o in log:
        i, k = o["entity_id"], o["op"]
        if (i in deletes and k != "delete_node") or (i in merges and k != "merge_into") or (i in lost):
            continue
        if k == "update_field" and i in node and o["field"] in ("description", "header"):
            node[i][o["field"]] = o["value"]
        elif k == "add_edge" and i in node:
            edges.append([node[i]["name"], o["target"], "references"])
        elif k == "delete_edge" and i in node:
            pair = {node[i]["name"], o["target"]}
            hit = next((x for x in edges if set(x[:2]) == pair), None)
            if hit:
                edges.remove(hit)
        elif k == "add_node" and f"windows::{o['name']}" not in node:
            node[f"windows::{o['name']}"] = {"name": o["name"], "description": o["description"], "header": None}
        elif k == "delete_node" and i in node:
            node.pop(i)
            lost.add(i)
        elif k == "merge_into" and i in node and o["target_id"] in node:
            a, b = node[i]["name"], node[o["target_id"]]["name"]
            edges = [[b if x == a else x for x in e[:2]] + e[2:] for e in edges]
            node.pop(i)
            lost.add(i)
        else:
            continue
        done.append(k)
    gone = {first[i]["name"] for i in lost if i in first and i not in node}
    return {i: (n["name"], n["description"], n["header"]) for i, n in node.items()}, sorted(e for e in edges if not gone & set(e[:2]))


def test_replay_equals_one_edit_after_another(spark):
    rng = random.Random(3)
    for trial in range(4):
        names = [f"T{trial}N{i}" for i in range(12)]
        edge = [(rng.choice(names), rng.choice(names), "references") for _ in range(25)]
        log = []
        for i in range(40):
            k = rng.choice(["update_field", "add_edge", "delete_edge", "delete_edge", "add_node", "delete_node", "merge_into"])
            who = rng.choice(names)
            log.append({"entity_id": f"windows::{who}", "op": k, "field": rng.choice(["description", "header", "color"]), "value": f"v{i}", "target": rng.choice(names), "name": f"T{trial}NEW{rng.randrange(3)}", "description": f"d{i}", "target_id": f"windows::{rng.choice(names)}"})
        want_nodes, want_edges = sequential(names, edge, log)
        e = spark.createDataFrame([(i, a, b, t, "f") for i, (a, b, t) in enumerate(edge)], EDGE)
        out = ops.replay(nodes(spark, names), e, edits(spark, log))
        assert {r.id: (r.name, r.description, r.header) for r in out.nodes.collect()} == want_nodes, trial
        assert sorted([r.source, r.target, r.type] for r in out.edges.collect()) == want_edges, trial


def test_chained_merges_and_modes(spark):
    e = spark.createDataFrame([(0, "A", "X", "references", "f"), (1, "D", "Y", "references", "f")], EDGE)
    log = [{"entity_id": "windows::A", "op": "merge_into", "target_id": "windows::B"}, {"entity_id": "windows::B", "op": "merge_into", "target_id": "windows::C"}, {"entity_id": "windows::D", "op": "delete_node"}, {"entity_id": "windows::C", "op": "add_node", "name": "D", "description": "again"}]
    strict = ops.replay(nodes(spark, "ABCD"), e, edits(spark, log))
    assert {r.name for r in strict.nodes.collect()} == {"C", "D"}
    assert {(r.source, r.target) for r in strict.edges.collect()} == {("C", "X"), ("D", "Y")}
    assert {r.op: r.n for r in strict.counts.collect()} == {"merge_into": 2, "delete_node": 1, "add_node": 1, "skipped": 0}
    compat = ops.replay(nodes(spark, "ABCD"), e, edits(spark, log), strict=False)
    assert {(r.source, r.target) for r in compat.edges.collect()} == {("C", "X")}
    itself = ops.replay(nodes(spark, "AB"), e.limit(0), edits(spark, [{"entity_id": "windows::A", "op": "merge_into", "target_id": "windows::A"}]))
    assert {r.name for r in itself.nodes.collect()} == {"B"}


GOOD = {"verdict": "merge", "confidence": 7, "summary": "s", "operations": [{"op": "add_edge", "target": "X"}, {"op": "fly"}]}


def test_answers():
    whole = json.dumps(GOOD)
    for raw in (whole, f"```json\n{whole}\n```", f"Sure: {whole}", f"<think>{{no}}</think>{whole}", whole.replace("}]", "},]"), '{verdict: "merge", confidence: 7, summary: "s", operations: [{op: "add_edge", target: "X"}]}', whole[:-2]):
        got = responses.parse(raw)
        assert (got["verdict"], got["confidence"], [o["op"] for o in got["operations"]]) == ("merge", 1.0, ["add_edge"]), raw
    assert responses.parse("nothing") is None and responses.parse(None) is None and responses.parse("") is None
    assert responses.parse('{"verdict": "burn", "confidence": "abc"}')["confidence"] == 0.5
    assert responses.parse('{"verdict": "burn", "confidence": -1}') == {"verdict": "keep", "confidence": 0.0, "summary": "", "operations": []}
    broken = '"verdict": "delete", "confidence": 0.8, "summary": "gone", "operations": [{"op": "update_field", "field": "header", "value": "x.h"}, {"op": "merge_into", "target_id": "windows::B" oops'
    got = responses.parse(broken)
    assert got["verdict"] == "delete" and [(o["op"], o["value"], o["target_id"]) for o in got["operations"]] == [("update_field", "x.h", None), ("merge_into", None, "windows::B")]
    assert responses.parse_winner('{"winner": "b"}') == "B" and responses.parse_winner('x "winner": "A" y') == "A" and responses.parse_winner("C") is None


def test_refinement(spark, tmp_path):
    n, e = nodes(spark, "ABC"), spark.createDataFrame([("A", "B", "references", "f")], "source string, target string, type string, source_file string")
    answer = lambda prompt: json.dumps({"verdict": "delete" if '"name":"B"' in prompt else "keep", "operations": []})
    out, answers = refine.refine(n, e, answer, workers=2)
    assert {r.name for r in out.nodes.collect()} == {"A", "C"} and out.edges.count() == 0 and answers.count() == 3
    export.append_answers(answers, str(tmp_path / "log"))
    again = documents.answer_log(spark, str(tmp_path / "log"))
    assert again.count() == 3 and {r.response.verdict for r in again.collect()} == {"keep", "delete"}
    assert [r.name for r in refine.pending(n, answers.select(F.col("entity_id").alias("id")).limit(0), limit=2).collect()] == ["A", "B"]
    assert refine.pending(n, min_confidence=0.4).count() == 0 and refine.estimate(120, 60) == 2


def test_enrichment(spark):
    item = "array<struct<name string, direction string, type string, description string>>"
    rows = [("1", "Open", "function", [("h", None, "const FOO_T *, BAR", None), ("x", None, "FOO_T", None)], "Baz *", "f"), ("2", "FOO_T", "struct", None, None, "f"), ("3", "BAR", "callback", None, None, "f"), ("4", "Baz", "Enum", None, None, "f")]
    ents = spark.createDataFrame(rows, f"id string, name string, entity_type string, parameters {item}, return_value string, source_file string")
    old = spark.createDataFrame([("FOO_T", "Open", "uses", "f")], "source string, target string, type string, source_file string")
    new = {(r.source, r.target, r.type) for r in enrich.type_edges(ents, old).collect()}
    assert new == {("Open", "FOO_T", "parameter_type"), ("Open", "Baz", "return_type"), ("Open", "Baz", "returns")}
    assert enrich.enriched(ents, old).where("_v41").count() == 3
    raw = {r.name: r._type_raw for r in enrich.clean_types(ents).collect()}
    assert raw == {"Open": None, "FOO_T": "struct", "BAR": None, "Baz": "Enum"}


def test_chat_client():
    config = reviewer.ChatConfig("http://x", "k", "m", requests_per_min=10**9)
    replies, slept = [(429, b""), (503, b""), (200, json.dumps({"choices": [{"message": {"content": "hi"}}], "usage": {"prompt_tokens": 3}}).encode())], []
    client = reviewer.ChatClient(config, send=lambda r: replies.pop(0), sleep=slept.append)
    assert client("p") == "hi" and slept == [1.5, 1.0] and (client.calls, client.errors, client.tokens_in) == (3, 2, 3)
    assert reviewer.ChatClient(config, send=lambda r: (404, b""), sleep=slept.append)("p") is None


def test_config(tmp_path):
    assert reviewer.load_config(str(tmp_path / "none.json")) is None
    (tmp_path / "c.json").write_text(json.dumps({"api_base_url": "u", "api_key": "k", "model_name": "m", "max_workers": 8, "ollama": {"api_base_url": "http://l"}}))
    assert reviewer.load_config(str(tmp_path / "c.json")).max_workers == 8
    local = reviewer.load_config(str(tmp_path / "c.json"), "ollama")
    assert (local.api_base_url, local.max_workers, local.requests_per_min) == ("http://l/v1", 2, 30)


def test_scans_stream_and_documents(spark, tmp_path):
    folder = tmp_path / "scans"
    folder.mkdir()
    for name in ("[OCR]_windows-a-_b_20260101_0203.p.txt", "[OCR]_windows-a-_b_20260101_0203.txt", "[OCR]_windows-c-_d_20260101_0203.txt", "other.txt"):
        (folder / name).write_bytes("函数\r\nOpenWidget 打开一个部件以供使用。\r\n".encode())
    scans = text.scan(spark, str(folder))
    assert scans.count() == 3
    got = {(r.base[-16:], r.p_file is None, r.t_file is None) for r in text.pairs(scans).collect()}
    assert got == {("_b_20260101_0203", False, False), ("_d_20260101_0203", True, False)}
    seen, hashes, table = [], str(tmp_path / "hashes"), str(tmp_path / "table")
    step = lambda df, n=0: seen.append(df.count())
    assert [incremental.run_available(spark, str(folder), hashes, step) for _ in range(2)] == [3, 0] and seen == [3]
    (folder / "[OCR]_windows-c-_d_20260101_0203.txt").write_text("new")
    assert incremental.run_available(spark, str(folder), hashes, step) == 1
    scans.write.parquet(table)
    for _ in range(2):
        incremental.run_stream(spark, table, str(tmp_path / "cp"), step).awaitTermination(120)
    assert seen == [3, 1, 3]
    todo, known = incremental.resume(scans, scans.select("file_name", "md5").limit(2))
    assert todo.count() == 1 and known.count() == 3

    doc = {"entities": [{"id": "windows::A", "name": "A", "return_value": {"type": "BOOL"}}, {"id": "", "name": "B"}, {"id": "windows::C", "name": "C", "return_value": "text"}]}
    out = tmp_path / "docs"
    out.mkdir()
    (out / "x.json").write_text(json.dumps(doc), encoding="utf-8")
    (out / "_p_x.json").write_text(json.dumps(doc), encoding="utf-8")
    rows = {r.name: r for r in documents.typed_returns(documents.nodes(spark, str(out))).collect()}
    assert set(rows) == {"A", "C"} and rows["A"].return_value.type == "BOOL" and rows["C"].return_value_text == "text"
    (out / "e.json").write_text(json.dumps({"data": {"edges": [{"from": "A", "to": "C", "edge_type": "uses"}]}}))
    assert [tuple(r)[:3] for r in documents.edges(spark, str(out / "e.json")).collect()] == [("A", "C", "uses")]
    assert export.content_hash([{"a": 1, "b": ["ü"]}]) == export.content_hash([{"a": 1, "b": ["ü"]}]) and len(export.content_hash([])) == 12
