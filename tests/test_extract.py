"""Lines, segments, field parsers and merging, against folds written here."""

import random

from pyspark.sql import functions as F

from graphloom.functions import text as T
from graphloom.grammar import GENERIC, OCR
from graphloom.operators import fields, lines, quality, segments
from graphloom.plans import extract

DOC = """2026-03-05 01:38:00
≦ 1 ≧
部件 API 项目 2025/01/02
需要以下标头：
widget.h
gadget.h
函数　
CloseWidget 关闭部件并释放资源，详见 OPEN_WIDGET_FLAGS。
语法
BOOL CloseWidget(
  HANDLE h
);
参数
[in] h
部件的句柄。
类型：HANDLE
flags
保留。 返回值
类型：BOOL。
成功时返回 TRUE。
备注
此函数已弃用。
要求
标头 widget.h
Widget.lib
Windows 8 [桌面应用]
另请参阅 OpenWidget
OpenWidget 打开一个部件以供使用。
常量
OPEN_WIDGET_FLAGS 打开部件时使用的标志。 NEXT_WIDGET_FLAGS
下一组标志的说明文字。
枚举
SMALL_ENUM 短
"""


def one(spark, text, g=OCR):
    docs = spark.createDataFrame([("d", "p", text)], "doc_id string, src string, text string")
    found, names = extract.entities_of(lines.explode_lines(docs), g)
    return {r.name: r.asDict(True) for r in found.collect()}, {r.name for r in names.collect()}


def test_document(spark):
    got, names = one(spark, DOC)
    assert set(got) == {"CloseWidget", "OpenWidget", "OPEN_WIDGET_FLAGS", "NEXT_WIDGET_FLAGS"}
    c = got["CloseWidget"]
    assert c["entity_type"] == "function" and c["deprecated"] is False and c["source_line"] == 8
    assert c["syntax"] == "BOOL CloseWidget(\nHANDLE h\n);"
    assert [(p["name"], p["direction"], p["type"], p["description"]) for p in c["parameters"]] == [("h", "in", "HANDLE", "部件的句柄。 flags 保留。")]
    assert c["return_value"] == {"type": "BOOL", "description": "成功时返回 TRUE。"}
    assert c["remarks"] == "此函数已弃用。"
    assert c["requirements"]["header"] == "widget.h" and c["requirements"]["library"] == "Widget.lib" and c["requirements"]["min_client"] == "Windows 8 [桌面应用]"
    assert c["cross_references"] == ["OPEN_WIDGET_FLAGS", "OpenWidget"]
    assert c["confidence"] == 0.65
    assert got["NEXT_WIDGET_FLAGS"]["description"] == "下一组标志的说明文字。" and got["NEXT_WIDGET_FLAGS"]["source_line"] == got["OPEN_WIDGET_FLAGS"]["source_line"]
    assert "SMALL_ENUM" in names


def test_title_and_headers(spark):
    docs = spark.createDataFrame([("d", "p", DOC.replace("\n", "\r\n"))], "doc_id string, src string, text string")
    rows = lines.explode_lines(docs)
    assert lines.title(rows).collect()[0].title == "部件 API"
    assert lines.headers_referenced(rows).collect()[0].headers_referenced == ["gadget.h", "widget.h"]


def fold(kinds):
    """The state machine line by line: (line, segment, bucket) of every line that belongs to an entity."""
    seg, open_, bucket, out = 0, False, "description", []
    for i, (section, marker, named) in enumerate(kinds):
        if section:
            open_ = False
        elif open_ and marker:
            bucket = marker
            out.append((i, seg, bucket))
        elif named:
            seg, open_, bucket = seg + 1, True, "description"
            out.append((i, seg, bucket))
        elif open_:
            out.append((i, seg, bucket))
    return out


def test_windows_equal_the_fold(spark):
    rng = random.Random(7)
    rows, want = [], {}
    for d in range(60):
        kinds = [(rng.random() < 0.15, rng.choice([None, None, "syntax", "remarks"]), rng.random() < 0.3) for _ in range(40)]
        want[str(d)] = fold(kinds)
        for i, (s, m, n) in enumerate(kinds):
            section, marker = ("enum" if s else None), (m if m and not s else None)
            rows.append((str(d), "p", i, "text", "text", section, None, None, (marker, "rest") if marker else None, ("NAME_X", "") if n and not s else None))
    schema = "doc_id string, src string, line_no int, text string, s string, section string, header string, at_end struct<key:string,before:string>, at_start struct<key:string,rest:string>, named struct<name:string,rest:string>"
    got = {}
    for r in segments.segment_lines(spark.createDataFrame(rows, schema)).collect():
        got.setdefault(r.doc_id, []).append((r.line_no, r.seg, r.bucket))
    assert {d: sorted(x) for d, x in got.items()} == {d: x for d, x in want.items() if x}


def values(spark, **columns):
    df = spark.createDataFrame([("x",)], "x string").select(*[c.alias(k) for k, c in columns.items()])
    return df.collect()[0].asDict(True)


def test_scalars(spark):
    v = values(
        spark, strip=T.strip(F.lit("　\xa0a b\t")), meta=T.is_meta(F.lit("枚举（x.h）项目2024/01/02")), header=T.header_name(F.lit("abc.h 标头")),
        clean=T.clean_text(F.lit("- 说明  文字。 要求 标头 x 另请参阅 y")), trail=T.clean_text(F.lit("说明。 NEXT_NAME")), infer=T.infer_type(F.lit("IOCTL_A"), F.lit("unknown")), kept=T.infer_type(F.lit("IOCTL_A"), F.lit("enum")),
        norm=T.normalize_type(F.lit(" Struct ")), odd=T.normalize_type(F.lit("delegate")), none=T.normalize_type(F.lit(None).cast("string")), tokens=T.type_tokens(F.lit("const FOO_TYPE *, _In_ (BAR)")),
        cut=T.truncate(F.lit("ab\ncd"), 3), short=T.truncate(F.lit(None).cast("string"), 3), hash=T.short_hash(F.lit("a")), part=T.part_opened(F.lit("参数：x")), notpart=T.part_opened(F.lit("参数化")),
        tail=T.part_at_end(F.lit("完成。 备注")), name=T.name_opened(F.lit("FOO_BARb x"), F.lit(False)), call=T.name_opened(F.lit("OpenIt(x)"), F.lit(False)), stop=T.name_opened(F.lit("Remarks are"), F.lit(True)),
    )
    assert v["strip"] == "a b" and v["meta"] and v["header"] == "abc.h"
    assert v["clean"] == "说明 文字。" and v["trail"] == "说明。" and v["infer"] == "ioctl" and v["kept"] == "enum"
    assert (v["norm"], v["odd"], v["none"]) == ("structure", "unknown", "unknown") and v["tokens"] == ["FOO_TYPE", "_In_", "BAR"]
    assert v["cut"] == "ab ..." and v["short"] == "" and v["hash"] == "ca978112ca1b"
    assert v["part"]["key"] == "parameters" and v["notpart"] is None and v["tail"] == {"key": "remarks", "before": "完成。"}
    assert v["name"]["name"] == "FOO_BA" and v["call"] == {"name": "OpenIt", "rest": "x)"} and v["stop"] is None


def test_file_meta(spark):
    v = values(spark, a=T.file_meta(F.lit("[OCR]_windows-some-api-_widget_20260102_0304.p.txt")), b=T.file_meta(F.lit("x.txt")), c=T.file_meta(F.lit("[OCR]_windows-other-thing_20260305_0203.txt")), d=T.output_name(F.lit("[OCR]_windows-a-_b_1.p.txt")))
    assert v["a"] == {"domain": "some-api", "topic": "widget", "ocr_time": "2026-01-02T03:04:00"} and v["b"]["domain"] == ""
    assert v["c"] == {"domain": "other", "topic": "thing", "ocr_time": "2026-03-05T02:03:00"} and v["d"] == "a-_b_1.json"


def test_numbers_are_rounded_by_their_binary_value(spark):
    xs = [0.5465, 0.4715, 0.6665, 0.0, 0.9985, 0.125, 0.0625, 0.444536, 0.9, 0.1, -0.0125]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", T.fixed(F.col("x"), 3).alias("a"), T.fixed(F.col("x"), 4).alias("b")).collect()
    assert all((r.a, r.b) == (f"{r.x:.3f}", f"{r.x:.4f}") for r in rows)


def test_field_parsers_on_empty_and_null(spark):
    for c in (F.array().cast("array<string>"), F.array(F.lit(""), F.lit("ﾉ"))):
        v = values(spark, p=fields.parameters(c), m=fields.members(c), r=fields.return_value(c), q=fields.requirements(c))
        assert v == {"p": [], "m": [], "r": None, "q": None}
    v = values(spark, m=fields.members(F.array(F.lit("a[3]"), F.lit("类型：INT"), F.lit("第一"), F.lit("b"))), r=fields.return_value(F.array(F.lit("值。 备注"), F.lit("不属于"))))
    assert v["m"] == [{"name": "a[3]", "type": "INT", "description": "第一"}, {"name": "b", "type": None, "description": ""}] and v["r"]["description"] == "值。"


def test_merging_repeated_names(spark):
    got, _ = one(spark, "函数\nOpenWidget 打开部件的说明。\n要求\nWidget.lib\n枚举\nOpenWidget 更长的说明文字，打开部件并等待。\n要求\nOther.lib\nwidget.dll\n")
    e = got["OpenWidget"]
    assert e["description"].startswith("更长") and e["entity_type"] == "function" and e["source_line"] == 2
    assert e["requirements"]["library"] == "Other.lib" and e["requirements"]["dll"] == "widget.dll"


def test_generic_grammar_and_empty_documents(spark):
    got, _ = one(spark, "OpenWidget opens a widget for use.\nmore text", GENERIC)
    assert got["OpenWidget"]["description"] == "opens a widget for use. more text"
    assert one(spark, "")[0] == {} and one(spark, None)[0] == {}


def test_decisions(spark):
    variants = spark.createDataFrame([("a", "p"), ("b", "t"), ("c", "p"), ("c", "t"), ("d", "p"), ("d", "t"), ("e", "p"), ("e", "t"), ("f", "p"), ("f", "t")], "doc_id string, src string")
    scored = spark.createDataFrame([("a", "p", 0.5), ("b", "t", 0.5), ("c", "p", 0.5), ("c", "t", 0.5), ("d", "p", 0.5), ("d", "t", 0.505), ("e", "p", 0.5), ("e", "t", 0.5049), ("f", "p", 0.9), ("f", "t", 0.1)], "doc_id string, src string, score double")
    got = {r.doc_id: (r.decision.split(" ")[0], r.winner) for r in quality.decide(variants, scored).collect()}
    assert got == {"a": ("only_p", "p"), "b": ("only_t", "t"), "c": ("identical", "p"), "d": ("heuristic_t", "t"), "e": ("llm_pending", "p"), "f": ("heuristic_p", "p")}
    rows = [("e", s, i, f"N{i}", "enum", "x", 0.5) for s in "pt" for i in range(9)]
    es = spark.createDataFrame(rows, "doc_id string, src string, ord int, name string, entity_type string, description string, confidence double")
    judged = {r.doc_id: (r.decision, r.winner) for r in quality.adjudicate(quality.decide(variants, scored), es, lambda a, b: "B" if len(a) == len(b) == 5 else None).collect()}
    assert judged["e"] == ("llm_t", "t") and judged["f"][1] == "p"
