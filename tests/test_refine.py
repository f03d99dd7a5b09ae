"""Refinement as a run: batches that are logged, resumed runs, usage, judging, the command line."""

import json

import pytest

from graphloom import cli
from graphloom.operators import quality
from graphloom.plans import refine
from graphloom.sinks import export
from graphloom.sources import documents, reviewer

NODE = "id string, name string, entity_type string, description string, header string, cross_references array<string>, confidence double, source_file string"
EDGE = "source string, target string, type string, source_file string"


def graph_of(spark, n):
    nodes = spark.createDataFrame([(f"windows::N{i}", f"N{i}", "function", f"text {i}", None, [], 0.5, f"f{i % 3}.json") for i in range(n)], NODE)
    return nodes, spark.createDataFrame([(f"N{i}", f"N{i + 1}", "references", "f") for i in range(n - 1)], EDGE)


def test_broken_off_run_is_resumed(spark, tmp_path):
    nodes, edges = graph_of(spark, 12)
    log, processed, work = (str(tmp_path / x) for x in ("answers", "processed", "work"))
    logged = []

    def done(got):
        export.append_answers(got, log)
        export.append_processed(got, processed)
        logged.append(got.count())
        if len(logged) == 2 and not resumed:
            raise RuntimeError("broken off")

    resumed = False
    answer = lambda prompt: json.dumps({"verdict": "delete" if '"name":"N3"' in prompt else "keep", "operations": []})
    with pytest.raises(RuntimeError):
        refine.refine(nodes, edges, answer, workers=1, folder=work, batch=3, done=done)
    first = sum(logged)
    assert 0 < first < 12
    resumed = True
    earlier, ids = documents.answer_log(spark, log), spark.read.parquet(processed).select("id")
    out, got = refine.refine(nodes, edges, answer, processed=ids, earlier=earlier, workers=1, folder=work, batch=3, done=done)
    assert got.count() == 12 - first and spark.read.parquet(processed).count() == 12
    assert {r.name for r in out.nodes.collect()} == {f"N{i}" for i in range(12)} - {"N3"}
    none, _ = refine.refine(nodes, edges, answer, workers=1, agreed=lambda edits: edits.count() == 0)
    assert none is None


def test_usage_adds_up_over_workers(spark):
    nodes, edges = graph_of(spark, 6)
    reply = json.dumps({"choices": [{"message": {"content": '{"verdict": "keep"}'}}], "usage": {"prompt_tokens": 3, "completion_tokens": 2}}).encode()
    client = reviewer.ChatClient(reviewer.ChatConfig("http://x", "k", "m", requests_per_min=10**9), send=lambda r: (200, reply), share=2)
    _, got = refine.refine(nodes, edges, client, workers=2)
    assert refine.usage(got).collect()[0].asDict() == {"calls": 6, "errors": 0, "tokens_in": 18, "tokens_out": 12}
    slept = []
    paced = reviewer.ChatClient(reviewer.ChatConfig("http://x", "k", "m", requests_per_min=60), send=lambda r: (200, reply), share=4, sleep=slept.append)
    paced("a"), paced("b")
    assert len(slept) == 1 and 3.5 < slept[0] <= 4 and "merge_into" in paced.system


def test_judge_decides_pending_pairs(spark):
    rows = [("d", s, i, f"{s}{i}", "function", "text", 0.5) for s in "pt" for i in range(9)]
    ents = spark.createDataFrame(rows, "doc_id string, src string, ord long, name string, entity_type string, description string, confidence double")
    pending = spark.createDataFrame([("d", "llm_pending", "p", 0.5, 0.501), ("e", "only_p", "p", 0.5, None)], "doc_id string, decision string, winner string, p_score double, t_score double")
    judge = reviewer.Judge(lambda prompt: '{"winner": "B"}' if '"t4"' in prompt and '"t5"' not in prompt else "none")
    got = {r.doc_id: (r.decision, r.winner) for r in quality.adjudicate(pending, ents, judge).collect()}
    assert got == {"d": ("llm_t", "t"), "e": ("only_p", "p")}


def test_command_line(spark, tmp_path):
    scans, out = tmp_path / "scans", str(tmp_path / "out")
    scans.mkdir()
    name = "[OCR]_windows-a-_{}_20260101_0203.p.txt"
    (scans / name.format("b")).write_text("函数\nOpenWidget 打开一个部件以供使用，然后返回。\n", encoding="utf-8")
    args = lambda *more: cli.parser().parse_args(["--input", str(scans), "--output", out, *more])
    cli.run(spark, args("--phase", "all"))
    assert [r.name for r in spark.read.parquet(f"{out}/refined/nodes").collect()] == ["OpenWidget"] and spark.read.json(f"{out}/refined/documents").count() == 1
    (scans / name.format("c")).write_text("函数\nCloseWidget 关闭部件，另见 OpenWidget 的说明文字。\n", encoding="utf-8")
    cli.run(spark, args("--phase", "extract"))
    rows = {r.name: r.cross_references for r in spark.read.parquet(f"{out}/entities").collect()}
    assert rows == {"OpenWidget": [], "CloseWidget": ["OpenWidget"]}
    cli.run(spark, args("--phase", "refine", "--resume"))
    assert spark.read.parquet(f"{out}/processed").count() == 2 and spark.read.parquet(f"{out}/refined/usage").collect()[0].calls == 0
