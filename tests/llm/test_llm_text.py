"""Canonical values, look-alikes, truncation and survivors: small fixtures and defined results."""

import datetime as dt
import itertools
import random

import pytest

from graphloom.llm import canonmap, charfold, lookalike, survivors, truncation

CANON = [(1, "entity_type", "struct", "结构"), (2, "entity_type", "function", "函数"), (3, "entity_type", "callback", "回调"), (4, "min_client", "Windows 7", "Windows 7"), (5, "min_client", "Windows 7 Service Pack 1", None), (6, "min_client", "Windows 10, version 1607", "Windows 10 版本 1607"), (7, "min_client", "Windows XP", None)]


def canon(spark):
    return spark.createDataFrame(CANON, "canon_id int, kind string, label string, label_zh string")


def typed(spark, rows):
    return spark.createDataFrame([(i, "d", f"n{i}", t, (m,)) for i, (t, m) in enumerate(rows)], "rec_id long, document_id string, name string, entity_type string, requirements struct<min_client:string>")


VALUES = [("struct", "Windows 7", None, None), ("strcut", "Win 7 (SP1)", 1, 5), ("ＳＴＲＵＣＴ\xa0", "Windos 7+", 1, 4), ("函数 / function", "Ｗｉｎｄｏｗｓ　１０　ｖ１６０７", 2, 6), ("callback function", "MS_Windows XP 。", 3, 7), ("license text", "Windows 8", -1, -1), ("", "Windows 10 version 1703", -1, -1), (None, None, None, None), ("functions", "W 7 or later", 2, 4), ("x" * 5000, "Windows 77", -1, -1)]


@pytest.mark.parametrize("most", [canonmap.MAX_TERMS, 0])
def test_values_meet_their_entries(spark, most):
    find = lambda e, c: canonmap.found(e, c, most)
    e = typed(spark, [v[:2] for v in VALUES])
    want = {(i, f, c) for i, v in enumerate(VALUES) for f, c in (("entity_type", v[2]), ("min_client", v[3])) if c is not None}
    assert {tuple(r) for r in find(e, canon(spark)).collect()} == want
    assert find(e.limit(0), canon(spark)).count() == 0
    assert {r.canon_id for r in find(e, canon(spark).limit(0)).collect()} == {-1}


def test_both_ways_answer_alike_on_random_lists(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcde 结12") for _ in range(rng.randrange(1, 50)))
    listed = [(i, rng.choice(["entity_type", "min_client"]), word(), rng.choice([None, word()])) for i in range(60)] + [(100, "entity_type", "macro", None), (101, "entity_type", "constant", "macro")]
    typos = [w[: (k := rng.randrange(len(w)))] + rng.choice(["", "a", "e"]) + w[k + 1 :] for _, _, w, _ in listed for _ in range(3)]
    values = [(x, y) for x, y in zip(typos + ["macro, constant", "constant / macro"], reversed(typos + ["", "x"]))]
    e, c = typed(spark, values), spark.createDataFrame(listed, "canon_id int, kind string, label string, label_zh string")
    one, other = ({tuple(r) for r in canonmap.found(e, c, most).collect()} for most in (canonmap.MAX_TERMS, 0))
    assert one == other and sum(r[2] >= 0 for r in one) > 50


def test_names_are_learned_from_rows_of_one_entity(spark):
    rows = [(f"n{i}", t, None) for i in range(8) for t in (["struct", "record"] if i % 2 else ["function", "routine", "see notes"] if i % 4 else ["struct", "see notes", "record"])]
    rows += [("lone", "recrod", None), ("lone", "routine", None), ("lone", "see notes", None)]
    e = spark.createDataFrame([(i, "d", n, t, (m,)) for i, (n, t, m) in enumerate(rows)], "rec_id long, document_id string, name string, entity_type string, requirements struct<min_client:string>")
    got = {rows[r.rec_id][1]: r.canon_id for r in canonmap.found(e, canon(spark)).collect()}
    assert got == {"record": 1, "recrod": 1, "routine": -1, "see notes": -1}  # two entities are too few for routine


def test_misses_are_reported(spark):
    got = {(r.field_name, r.value): r.n_rows for r in canonmap.misses(typed(spark, [("foo", None), ("foo", None), ("struct", None)]), canon(spark)).collect()}
    assert got == {("entity_type", "foo"): 2}


def test_deletes_find_every_term_within_two_edits():
    for a, b in itertools.product(["struct", "strcut", "sruct", "xstruct", "sxtruct"], repeat=2):
        assert canonmap.deletes(a) & canonmap.deletes(b)
    assert canonmap.distance("windows 7", "windows 8") > 1e6 and canonmap.distance("abc", "acb") == 0.7 and canonmap.distance("abc", "abc") == 0
    assert "7" in "".join(canonmap.deletes("w 7")) and all("7" in d for d in canonmap.deletes("w 7"))


LOOK = [("Name", "Nаme"), ("a b", "a\xa0b"), ("caf\u00e9", "cafe\u0301"), ("ＡＢ", "AB"), ("x", "x​"), ("ﬁle", "file"), ("ガ", "ｶﾞ"), ("⼤", "大"), ("порт", "пoрт"), ("façade name", "façade nаmе")]


def named(spark, pairs):
    rows = [(2 * i + j, f"d{i}", n, None) for i, p in enumerate(pairs) for j, n in enumerate(p)]
    return spark.createDataFrame(rows, "rec_id long, document_id string, name string, description string")


def test_texts_that_look_the_same(spark):
    differ = [("x²", "x2"), ("①", "1"), ("Ab", "ab"), ("same", "same"), ("a  b", "a b"), (None, ""), ("", "")]
    got = {tuple(r) for r in lookalike.found(named(spark, LOOK + differ)).collect()}
    assert got == {(2 * i, 2 * i + 1, "name") for i in range(len(LOOK))}
    assert lookalike.found(named(spark, [("a", "b")]).limit(0)).count() == 0


def test_many_rows_of_one_text_are_not_paired_with_each_other(spark):
    rows = [(i, "d", "N", "text" if i else "tеxt") for i in range(300)]
    e = spark.createDataFrame(rows, "rec_id long, document_id string, name string, description string")
    got = lookalike.found(e).collect()
    assert len(got) == 299 and all(r.rec_id_a == 0 for r in got)


def test_canonical_spelling_and_trie(spark):
    got = {r.rec_id: r.canonical for r in lookalike.consistent(named(spark, [("Word", "Wоrd"), ("запись", "зaпись")])).collect()}
    assert got == {1: "Word", 3: "запись"}
    trie = lookalike.Trie([("word", 3), ("ward", 1), ("façade", 1), ("Info", 2), ("token", 1), ("сор", 9), ("cop", 1)])
    assert trie.walk("wоr​d") == ("word", 0) and trie.walk("façade") == ("façade", 0) and trie.walk("wxrd") is None
    assert trie.walk("ӏnfо") == ("Info", 0.2) and trie.walk("toкen") == ("token", 0.3) and trie.walk("toкen", 0.1) is None and trie.walk("сop") == ("cop", 0)
    long = "а" * 100_000
    assert charfold.skeleton(long) == "a" * 100_000 and lookalike.cut("a\0b\r") == ("ab ", [])


def test_trie_equals_comparison_with_every_word():
    rng = random.Random(5)
    near = lookalike.near_forms(lookalike.NEAR)
    alphabet = "lIikкtтnηпoаeо"
    words = {"".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 5))): rng.randrange(1, 4) for _ in range(400)}
    words = {w: n for w, n in words.items() if lookalike.is_clean(w)}
    trie, of = lookalike.Trie(words.items()), lookalike.anchors(lookalike.NEAR)

    def cost(a, b):
        a, b = charfold.skeleton(a), charfold.skeleton(b)
        return sum(0 if x == y else dict(near.get(x, ())).get(y, 99) for x, y in zip(a, b)) if len(a) == len(b) else 99

    some = 0
    for _ in range(600):
        spelling = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 5)))
        want = min(((round(cost(spelling, w), 6), not w.isascii(), -n, w) for w, n in words.items()))
        want = (want[3], want[0]) if want[0] <= lookalike.BUDGET else None
        assert trie.walk(spelling) == want, spelling
        some += want is not None and want[1] > 0
        if want:  # what can be reached is in the same shard
            assert [of.get(c, c) for c in charfold.skeleton(spelling)] == [of.get(c, c) for c in charfold.skeleton(want[0])]
    assert some > 20


def test_words_that_only_the_trie_finds(spark):
    e = named(spark, [("Info about tokens", "ӏnfо about toкens"), ("запись", "зaпись"), ("Info", "Info"), ("tokens", "tokens")])
    assert {(r.spelling, r.word, r.by_table) for r in lookalike.chosen(e).collect()} == {("ӏnfо", "Info", "lnfo"), ("toкens", "tokens", "toкens"), ("запись", "запись", "зaпиcь"), ("зaпись", "запись", "зaпиcь")}
    assert {tuple(r) for r in lookalike.found(e).collect()} == {(0, 1, "name"), (2, 3, "name")}


def test_membership_gives_all_pairs(spark):
    rows = [(i, "d" if i else None, "N", ["text", "tеxt", "te​xt", "other"][i % 4]) for i in range(41)]
    e = spark.createDataFrame(rows, "rec_id long, document_id string, name string, description string")
    member = lookalike.classes(e).collect()
    assert len(member) == 30 and {r.same_text for r in member} == {1, 2, 4} and {r.same_look for r in member} == {1}
    by = {(a.rec_id, b.rec_id) for a in member for b in member if a.rec_id < b.rec_id and a.same_look == b.same_look and a.same_text != b.same_text}
    assert by == {(r.rec_id_a, r.rec_id_b) for r in lookalike.found(e).collect()}


def cut_rows(spark):
    whole = lambda i: ["The caller must flush the cache before it uses OpenWidgetList{}.", "仅供 OpenWidgetList{} 内部使用", "对于 CloseWidgetMode{} 的说明见下表。", "Handle to the cache of OpenWidgetList{}"][i % 4].format(i)
    rows = [(i, "t", "f", whole(i), None) for i in range(160)]
    cut = ["The caller must flush the ca", "The caller must flush", "The caller must fl…", "对于 CloseWidgetMode 的说", "The caller must flush the cache before it uses Open", "The caller ..."]
    return rows + [(1000 + i, "t", "g", c, "x") for i, c in enumerate(cut)] + [(2000, "t", "g", None, None), (2001, "t", "g", "", None), (2002, "p", "g", "The caller must fl", ""), (2003, None, "g", "The caller must fl", None)]


def test_cut_texts(spark):
    e = spark.createDataFrame(cut_rows(spark), "rec_id long, src string, feed string, description string, remarks string")
    assert {tuple(r) for r in truncation.found(e).collect()} == {(1000 + i, "description") for i in range(6)}
    report = {(r.feed, r.field_name): (r.n_texts, r.n_cut) for r in truncation.report(e).collect()}
    assert report == {("f", "description"): (160, 0), ("g", "description"): (6, 6)}
    assert truncation.found(e.limit(0)).count() == 0


SCHEMA = "refined_id long, document_id string, name string, entity_type string, description string, syntax string, remarks string, header string, return_value string, confidence double, origin string, refined_at timestamp, extra int"
T = lambda n: dt.datetime(2025, 1, 1) + dt.timedelta(days=n)


def row(i, name, at, doc="d", description="text", conf=0.5, origin="p", **more):
    return (i, doc, name, more.get("entity_type"), description, more.get("syntax"), None, more.get("header"), None, conf, origin, T(at), 1)


def test_best_rows(spark):
    rows = [
        row(1, "OpenIt", 1), row(2, "ns::openit()", 2, description="longer text"), row(3, " OPEN_IT ", 2, doc="e"),  # 2 is best of its group
        row(4, "Twice", 5), row(5, "Twіce", 5),  # equal rows: none
        row(6, "Split", 1, header="h"), row(7, "`Split`", 2),  # 7 lacks the header
        row(8, "Holder", 1, header="N/A"), row(9, "Holder", 2, conf=1.5), row(10, "Holder64", 9),  # confidence out of range
        row(11, None, 1), row(12, None, 2), row(13, "__", 1), row(14, "__", 2), row(15, "NoDoc", 1, doc=None), row(16, "NoDoc", 2, doc=None),
        row(17, "Nan", 1, conf=float("nan")), row(18, "Nan", 2, conf=None),
    ]
    r = spark.createDataFrame(rows, SCHEMA)
    assert {x.refined_id for x in survivors.found(r).collect()} == {2, 18}
    best = {x.name_key: x for x in survivors.survivors(r).collect()}
    assert best["split"].header == "h" and best["split"].n_rows == 2 and best["holder"].header is None and best["openit"].description in ("longer text", "text")
    assert survivors.found(r.limit(0)).count() == 0
