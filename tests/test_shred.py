"""Nested records: levels, forms of holding children, and defined results."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from graphloom.operators import shred


def children(payload):
    try:
        columns = shred.shred_value(shred.parse_payload(payload))
    except shred.NotJson:
        return set()
    rows = shred._assembled(columns)[1]
    return {(c["entity_name"], c["child_kind"], c["child_path"]) for c in rows if c["entity_name"] and c["child_path"] and (c["child_kind"] != "requirement" or c["value"] is not None)}


def brute(entities):
    out = set()

    def walk(entity, members, above):
        for m in members or []:
            if m.get("name"):
                out.add((entity, "member", "/".join([*above, m["name"]])))
                walk(entity, m.get("members"), [*above, m["name"]])

    for e in entities:
        if e.get("name"):
            walk(e["name"], e.get("members"), [])
            for p in e.get("parameters") or []:
                if p.get("name"):
                    out.add((e["name"], "parameter", p["name"]))
    return out


names = st.sampled_from(["a", "b", "c", "", None])
member = st.recursive(st.fixed_dictionaries({"name": names}), lambda inner: st.fixed_dictionaries({"name": names, "members": st.lists(inner, max_size=3)}), max_leaves=8)
entity = st.fixed_dictionaries({"name": names, "members": st.lists(member, max_size=3), "parameters": st.lists(st.fixed_dictionaries({"name": names}), max_size=3)})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(entity, max_size=3), max_size=3))
def test_levels_rebuild_any_tree(docs):
    payload = json.dumps([{"document": {"document_id": str(i)}, "entities": es} for i, es in enumerate(docs)])
    assert children(payload) == brute([e for es in docs for e in es])


def test_forms_of_holding_children():
    for held in ([{"name": "m"}], {"m": {}}, {"items": [{"name": "m"}]}, {"name": "m"}, json.dumps([{"name": "m"}]), [[{"name": "m"}], None], {"m": None}):
        assert children(json.dumps({"data": {"entities": {"E": {"members": held}}}})) == {("E", "member", "m")}, held
    assert children(json.dumps({"entities": [{"name": "E", "requirements": [{"key": "dll", "value": "x"}, {"key": "lib", "value": None}]}]})) == {("E", "requirement", "dll")}


def test_payloads_that_are_not_one_value():
    good = '{"entities": [{"name": "E", "parameters": [{"name": "p"}]}]}'
    assert children("﻿ " + good) == {("E", "parameter", "p")}
    for bad in (None, "", "  ", good + "}", good[:-5], "<html>" + good, good + good, '{"a": NaN}', "[" * 100_000):
        assert children(bad) == set()


values = st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(), lambda v: st.lists(v, max_size=4) | st.dictionaries(st.text(max_size=4), v, max_size=4), max_leaves=20)


@settings(max_examples=300, deadline=None)
@given(values, st.integers(0, 40), st.sampled_from(["", "]", ",", '"', "}", "1"]))
def test_own_parser_equals_the_library(value, at, extra):
    for text in (json.dumps(value, ensure_ascii=False), json.dumps(value, indent=1)):
        broken = text[:at] + extra + text[at:]
        for t in (text, broken):
            try:
                want = json.loads(t, parse_constant=shred._no_constant)
            except ValueError:
                want = ValueError
            try:
                got = shred.load_deep(t)
            except ValueError:
                got = ValueError
            assert got == want, t


def test_members_of_any_depth():
    deep, depth = '{"name": "m"}', 5000
    for _ in range(depth - 1):
        deep = f'{{"name": "m", "members": [{deep}]}}'
    got = children(f'{{"entities": [{{"name": "E", "members": [{deep}]}}]}}')
    assert len(got) == depth and max(len(p) for _, _, p in got) == 2 * depth - 1


def test_nothing_of_an_entity_is_lost(spark):
    record = {"document": {"document_id": "d"}, "entities": [{"name": "E", "cross_references": ["A", {"name": "B"}, None, ["C"]], "return_value": {"type": "int", "more": {"x": [1, 2]}}, "header": "h.h", "members": [{"type": "t", "members": [{"name": "n"}]}, {"name": "m"}]}, {"cross_references": '["D"]', "parameters": [{"name": "p"}], "return_value": None}, {"name": "F"}]}
    shredded = shred.shred(spark.createDataFrame([(1, json.dumps(record))], "record_id long, payload string"))
    assert [(r.entity_name, r.nth, r.target) for r in shred.reference_table(shredded).collect()] == [("E", 0, "A"), ("E", 1, "B"), ("E", 2, "C"), (None, 0, "D")]
    assert [(r.entity_no, r.key, r.value) for r in shred.value_table(shredded).collect()] == [(0, "return_value.type", "int"), (0, "return_value.more.x", "1"), (0, "return_value.more.x", "2"), (0, "header", "h.h"), (1, "return_value", None)]
    kids = {(r.entity_no, r.child_path, r.type, r.child_no, r.parent_no) for r in shred.child_table(shredded).collect()}
    assert kids == {(0, None, "t", "0.0", "0"), (0, None, None, "0.0.0", "0.0"), (0, "m", None, "0.1", "0"), (1, "p", None, "1.0", "1")}
    assert shred.found(spark.createDataFrame([(1, json.dumps(record))], "record_id long, payload string")).count() == 1


def test_tables_with_nulls_empty_and_extra_columns(spark):
    rows = [(1, '{"document": {"document_id": "d"}, "entities": [{"name": "E", "members": [{"name": "m", "members": [{"name": "n"}]}]}]}', "x"), (2, None, "y"), (None, "{}", "z"), (3, "broken", None)]
    raw = spark.createDataFrame(rows, "record_id long, payload string, columns string")
    kids = {(r.child_path, r.child_no, r.parent_no) for r in shred.child_table(shred.shred(raw)).collect()}
    assert kids == {("m", "0.0", "0"), ("m/n", "0.0.0", "0.0")}
    assert {r.record_id for r in shred.malformed(raw).collect()} == {2, 3}
    assert shred.found(raw.limit(0)).count() == 0
    assert shred.document_table(shred.shred(raw)).collect()[0].document_id == "d"
