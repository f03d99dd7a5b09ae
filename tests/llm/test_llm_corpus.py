"""Encoding, mixing, spam and scanned text: brute force, round trips and defined results."""

import collections
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from graphloom.llm import encode, mixing, ocrrepair, spam

LIB = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    t = LIB.Tokenizer.from_file(f"{encode.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def own():
    t = encode.tokenizer(f"{encode.TOKENIZERS}/{encode.RANK_FILE}")

    def run(texts):
        offsets, ids = t.encode_batch(texts)
        return [ids[offsets[i] : offsets[i + 1]].tolist() for i in range(len(texts))]

    return run


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=8))
def test_ids_equal_the_library(library, own, texts):
    assert own(texts) == library(texts)


def test_ids_of_odd_texts(library, own):
    rng = random.Random(1)
    odd = ["", "<|endoftext|>", "x" * 5000, "ab" * 3000, "".join(rng.choice("abcdefgh") for _ in range(4000)), " \n\t x\r\n", "é" * 900, "中文" * 500, "😀👍🏽" * 100]
    assert own(odd) == library(odd)
    assert own([None]) == [[]]


def test_matrix_equals_heap():
    t, rng = encode.tokenizer(f"{encode.TOKENIZERS}/{encode.RANK_FILE}"), random.Random(2)
    pieces = ["".join(rng.choice("aeinrst ") for _ in range(rng.randrange(2, 60))).encode() for _ in range(200)]
    assert [x.tolist() for x in t._matrix(pieces, 64)] == [t._heap(p).tolist() for p in pieces]


def test_encoding_keeps_every_row(spark):
    docs = spark.createDataFrame([(1, "a", 1), (2, None, 2), (3, "", 3), (1, "a", 4), (None, "b", 5)], "doc_id long, text string, ids int")
    assert sorted((r.doc_id or 0, len(r.ids)) for r in encode.encode(docs).collect()) == [(0, 1), (1, 1), (1, 1), (2, 0), (3, 0)]
    assert encode.encode(docs.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=8))
def test_schedule_deviates_by_less_than_a_block(weights):
    total, seen = sum(weights), collections.Counter()
    slots = mixing.schedule(weights)
    assert collections.Counter(slots) == collections.Counter({i: w for i, w in enumerate(weights)})
    for t, s in enumerate(slots, 1):
        seen[s] += 1
        assert all(abs(seen[i] - w * t / total) < 1 for i, w in enumerate(weights))


def mix_tables(spark):
    rows = [(i, f"text number {i} of a", "a") for i in range(400)] + [(1000 + i, f"words {i} b", "b") for i in range(30)] + [(2000 + i, "the same text again and again", "a") for i in range(200)]
    rows += [(3000, None, "a"), (3001, "", "b"), (3002, "none", None), (3003, "other", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return docs, spark.createDataFrame([("a", 0.6, 1), ("b", 0.3, 3), ("c", 0.1, 2), ("z", 0.0, 1)], "source string, target_share double, max_repeats int")


def test_mix_meets_shares_and_repeats(spark):
    docs, targets = mix_tables(spark)
    got = mixing.mix(docs, targets, blocks=90).collect()
    assert len({r.doc_id for r in got}) == len(got) and all(r.repeats <= {"a": 1, "b": 3}[r.source] for r in got)
    assert sum(2000 <= r.doc_id < 3000 for r in got) <= 1
    by = {r.source: r for r in mixing.shares(docs, targets).collect()}
    assert abs(by["a"].actual_share - 2 / 3) < 0.02 and abs(by["b"].actual_share - 1 / 3) < 0.02 and by["c"].n_tokens == 0 and by["b"].most_repeats == 3
    assert mixing.mix(docs.limit(0), targets).count() == 0 and mixing.mix(docs, targets.limit(0)).count() == 0


def test_delivered_tokens_stay_within_a_block_of_the_weights(spark):
    docs, targets = mix_tables(spark)
    docs = docs.unionByName(spark.createDataFrame([(5000, "a long text of words " * 400, "a")], docs.schema))
    got = mixing.mix(docs, targets, blocks=90, measure=mixing.characters).collect()
    given, held, blocks = collections.Counter(), collections.defaultdict(collections.Counter), collections.Counter()
    for r in got:
        given[r.source] += r.n_tokens * r.repeats
        for c in range(r.repeats):  # every token of every copy stands in exactly one slot
            spans = sorted((x.begin, x.end) for x in r.spans if x.copy == c)
            assert spans[0][0] == 0 and spans[-1][1] == r.n_tokens and all(x[1] == y[0] for x, y in zip(spans, spans[1:])) and all(x < y for x, y in spans)
        for x in r.spans:
            held[x.slot][r.source] += x.end - x.begin
    assert sorted(held) == list(range(90)) and all(len(h) == 1 for h in held.values()) and max(len(r.spans) for r in got) > 20
    for h in held.values():
        blocks.update(h.keys())
    seen = collections.Counter()
    for t in range(90):
        seen.update(held[t])
        assert all(abs(seen[s] - given[s] * (t + 1) / 90) <= given[s] / blocks[s] + 1 for s in given), t


HONEST = "The caller must open the handle before it uses the queue. If the queue is empty, the call returns at once. " * 4
PAGES = [
    (1, HONEST, False), (2, "Widget free | Widget cheap | Widget best | " * 12, True), (3, "\n".join(f"http://a.example/{i}" for i in range(20)), True), (4, "\n".join(f"#Tag{i}下载" for i in range(30)), True),
    (5, HONEST[:110] + "\n" + "\n".join(f"Widget{i} cheap driver" for i in range(40)), True), (6, "\n".join(f"http://a.example/{i}\nThis page explains how the handle is opened and what it returns." for i in range(8)), False),
    (7, "int f(void)\n{\n    x += 1;\n    if (y != 2) { return -1; }\n    g(&x);\n    return 0;\n}\n" * 4, False), (8, "值\t含义\n" + "\n".join(f"FLAG_{i}\t0x{i}\t表示该队列的第 {i} 个状态可以被读取。" for i in range(8)), False),
    (9, "Why Widget driver? Simply because Widget driver beats Widget driver. " * 8, True), (10, None, False), (11, "", False), (12, "0", False), (13, "Widget free | Widget cheap | Widget best | " * 12, True),
    (14, "Die Warteschlange ist leer und der Aufruf kehrt sofort wieder zurück. " * 6, False), (15, HONEST * 3000, False),
]


def test_spam_pages(spark):
    docs = spark.createDataFrame([(i, t) for i, t, _ in PAGES], "doc_id long, text string")
    assert {r.doc_id for r in spam.found(docs).collect()} == {i for i, _, bad in PAGES if bad}
    assert spam.found(docs.limit(0)).count() == 0 and sum(r.n_docs for r in spam.report(docs).collect()) == 13


def scanned(spark):
    body = ["The caller must flush the cache before the adap-", "ter is used again by another caller.", "Each cache carries a checksum of its own.", "设置 flags 为 0x4 可以关闭缓存的自动提交。", "读取缓存的结果并写入缓存。"]
    rows, n = [], 0
    for f in range(30):
        lines = ["Widget Queue Reference", *body, "Page 7 of 9", "Widget Queue Reference | Notes", *body, "", "8", "Widget Queue Referencc", *body, None, "4096", "Value of the flag"]
        for i, t in enumerate(lines):
            rows.append((n, "d", "p", f"f{f}", i, "description", t))
            n += 1
    extra = ["Widget Queue Reference", "Thc callcr must flush the cache before the adap-", "12", "Widget Queue Reference", "tcr is used again by another caller.", "读取暖存的结果并写入缓存。", "pool -", "usually"]
    rows += [(10_000 + i, "d", "p", "last", i, "description", t) for i, t in enumerate(extra)]
    return spark.createDataFrame(rows + [(20_000, "d", "p", None, 0, None, "no file")], "line_id long, document_id string, src string, file_name string, line_no int, section string, text string")


def test_scanned_lines(spark):
    got = collections.defaultdict(set)
    for r in ocrrepair.found(scanned(spark)).collect():
        got[r.line_id].add(r.fault)
    # of the first file: title and content are clean
    assert 0 not in got and got[1] == {"hyphen"} and got[6] == {"page_number"} and got[7] == {"header"} and 13 not in got and got[14] == {"page_number"} and got[15] == {"header"} and 22 not in got
    assert got[10_001] == {"misread", "hyphen"} and got[10_002] == {"page_number"} and got[10_003] == {"header"} and got[10_004] == {"misread"}
    assert 10_000 not in got and 10_006 not in got and 20_000 not in got
    assert ocrrepair.found(scanned(spark).limit(0)).count() == 0


def test_paragraphs(spark):
    text = {r.paragraph_no: r.text for r in ocrrepair.paragraphs(scanned(spark)).where("file_name = 'last'").collect()}
    whole = " ".join(text[k] for k in sorted(text))
    assert "The caller must flush the cache before the adapter is used again by another caller." in whole and "读取缓存的结果" in whole


def test_words_undone_and_decoded():
    assert "the" in ocrrepair.undone("tbe") and "modern" in ocrrepair.undone("modem") and ocrrepair.undone("") == {}
    options = {1: [("caller", 0.2, 900)]}
    assert ocrrepair.viterbi(["the", "callcr", "must"], options, {1: 1}, {"the caller": 500, "caller must": 400}) == {1: "caller"}
    assert ocrrepair.viterbi(["a", "be", "c"], {1: [("he", 0.001, 1)]}, {1: 500}, {"a be": 400, "be c": 400}) == {}


@pytest.mark.parametrize("name", ["p8_ids", "p9_shares", "p10_report", "p2_misses", "p4_report", "p6_found", "p6_survivors"])
def test_queries(spark, small, name):
    from compare import duck_rows, spark_rows
    from graphloom.llm import queries

    cols, rows = spark_rows(queries.queries()[name](spark, small))
    assert rows
    if name in queries.oracle_sql():
        assert (cols, rows) == duck_rows(queries.oracle_sql()[name], small)


def test_misread_column_is_typed(spark):
    none = scanned(spark).limit(0)
    assert [f.dataType.simpleString() for f in ocrrepair.decoded(ocrrepair.words_of(ocrrepair.joined(ocrrepair.furniture(none)))).schema] == ["bigint", "bigint", "int", "int", "int", "string", "string"]
