"""Nested JSON documents to flat tables by columnar shredding.

``shred`` turns every payload into columns, one per leaf path, each a sequence of (repetition level,
definition level, value). ``assemble`` rebuilds a flat table per repeated ancestor from those level
sequences alone: the ordinal of an ancestor at depth k is the running count of entries whose repetition
level is at most k, which also gives every row the keys of its parents.

Both steps are narrow: one record is shredded and assembled where it was read, nothing is shuffled, and a
skewed source only makes more rows, not larger groups.

Defined results. A payload that is null, blank, or not exactly one JSON value gives no rows (``malformed``
lists it). A leading byte-order mark or blank is skipped. Children may be held as a list, a list of lists, a
single object, an object keyed by name, an object wrapping one list, or text holding any of these; nulls in
a list are skipped. A child without a name has no path, nor has what it holds; ``child_table`` keeps both, ``found`` leaves them out.
Every other field of an entity is kept, too: ``reference_table`` holds its cross references, ``value_table`` all further fields by dotted key.
Members may nest to any depth: what is too deep for the library's parser is read by one with a stack of its own.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: One shredded column: path of the leaf, its maximal repetition level, and three parallel sequences.
SHREDDED = (
    "record_id long, columns array<struct<path string, max_rep int, reps array<int>, defs array<int>, vals array<string>>>"
)
#: Scalar leaves of an entity and of a child.
ENTITY_LEAVES = ("id", "name", "entity_type", "description", "confidence")
#: Fields of an entity that have tables of their own.
HELD = {*ENTITY_LEAVES, "parameters", "members", "requirements", "cross_references"}
REFERENCES = "record_id long, entity_no int, entity_name string, nth int, target string"
VALUES = "record_id long, entity_no int, entity_name string, key string, value string"
#: Keys that are fields of a body, never a wrapper around a list.
FIELDS = {"name", "parameters", "members", "requirements", "cross_references"}
CHILD_LEAVES = ("name", "type", "direction", "description")
CHILDREN = "record_id long, entity_no int, entity_name string, child_kind string, child_path string, depth int, child_no string, parent_no string, type string, direction string, description string, value string"
ENTITIES = "record_id long, document_id string, title string, entity_no int, " + ", ".join(f"{c} string" for c in ENTITY_LEAVES)


class NotJson(ValueError):
    """The payload is not exactly one JSON value."""


def _no_constant(text: str) -> None:
    raise NotJson(text)


def parse_payload(payload: str | None) -> Any:
    """The payload's single JSON value; NotJson if it holds none or more."""
    if payload is None:
        raise NotJson("null")
    try:
        return _load(payload.lstrip("\ufeff \t\r\n"))
    except ValueError as e:
        raise NotJson(str(e)) from e


def _load(text: str) -> Any:
    try:
        return json.loads(text, parse_constant=_no_constant)
    except RecursionError:
        return load_deep(text)


_PIECE = re.compile(r'[ \t\r\n]*(?:([{}\[\]:,])|("(?:[^"\\\x00-\x1f]|\\.)*")|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null))')


def load_deep(text: str) -> Any:
    """The JSON value of a text, nested to any depth; ValueError if it is not exactly one."""
    done: list[Any] = []  # the finished value
    open_: list[tuple[Any, list[str]]] = []  # containers, an object with its pending key
    at, expect = 0, "value"

    def put(value: Any) -> str:
        if not open_:
            done.append(value)
            return "end"
        holder, key = open_[-1]
        if isinstance(holder, dict):
            holder[key.pop()] = value
        else:
            holder.append(value)
        return "comma"

    while m := _PIECE.match(text, at):
        at, mark = m.end(), m.group(1)
        if mark in ("}", "]"):
            closes = dict if mark == "}" else list
            if not open_ or not isinstance(open_[-1][0], closes) or expect not in ("comma", "first"):
                raise ValueError("bracket")
            open_.pop()
            expect = "comma" if open_ else "end"
        elif mark == ",":
            if expect != "comma":
                raise ValueError("comma")
            expect = "key" if isinstance(open_[-1][0], dict) else "value"
        elif mark == ":":
            if expect != "colon":
                raise ValueError("colon")
            expect = "value"
        elif expect == "key" or (expect == "first" and isinstance(open_[-1][0], dict)):
            if m.group(2) is None:
                raise ValueError("key")
            open_[-1][1].append(json.loads(m.group(2)))
            expect = "colon"
        elif expect not in ("value", "first"):
            raise ValueError("value")
        elif mark:
            value: Any = {} if mark == "{" else []
            put(value)
            open_.append((value, []))
            expect = "first"
        else:
            expect = put(json.loads(m.group(2) or m.group(3)))
    if expect != "end" or text[at:].strip(" \t\r\n"):
        raise ValueError("not one value")
    return done[0]


def _opened(value: Any) -> Any:
    """Text that holds a JSON list or object counts as that list or object."""
    while isinstance(value, str):
        inner = value.strip()
        if inner[:1] not in ("[", "{"):
            return None
        try:
            value = _load(inner)
        except ValueError:
            return None
    return value


def items(container: Any) -> Iterator[tuple[str | None, dict]]:
    """(key, body) of every child in a container of any of the supported forms, in order."""
    container = _opened(container)
    if isinstance(container, list):
        for x in container:
            if isinstance(x, (list, str)) or (isinstance(x, dict) and len(x) == 1 and not FIELDS & set(x) and isinstance(_first(x), list)):
                yield from items(x)
            elif isinstance(x, dict):
                yield None, x
    elif isinstance(container, dict):
        if isinstance(container.get("name"), (str, int, float)):
            yield None, container
        elif len(container) == 1 and isinstance(_opened(_first(container)), list):
            yield from items(_first(container))
        else:
            for key, body in container.items():
                yield key, body if isinstance(body, dict) else {}


def _first(d: dict) -> Any:
    return next(iter(d.values()))


def pairs(container: Any) -> Iterator[tuple[str, Any]]:
    """(key, value) of a requirement-like container: an object, or a list of key/value objects."""
    container = _opened(container)
    if isinstance(container, dict):
        if set(container) == {"key", "value"}:
            yield container["key"], container["value"]
        else:
            yield from container.items()
    elif isinstance(container, list):
        for x in container:
            x = _opened(x) if isinstance(x, str) else x
            if isinstance(x, (dict, list)):
                yield from pairs(x)


def documents_in(value: Any) -> Iterator[dict]:
    """Objects with entities, below any wrapping objects or lists."""
    stack = [value]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            x = _opened(x)
        if isinstance(x, dict):
            if "entities" in x:
                yield x
            else:
                stack.extend(reversed([v for v in x.values() if isinstance(v, (dict, list))]))
        elif isinstance(x, list):
            stack.extend(reversed(x))


def _text(value: Any) -> str | None:
    if value is None or isinstance(value, str):
        return value
    try:
        return json.dumps(value, ensure_ascii=False)
    except RecursionError:  # a value where a scalar belongs, nested beyond what can be written again
        return str(type(value).__name__)


def further(entity: dict) -> Iterator[tuple[str, Any]]:
    """(dotted key, value) of every field of an entity that has no table of its own, in order."""
    stack = [(k, v) for k, v in reversed(entity.items()) if k not in HELD]
    while stack:
        key, value = stack.pop()
        if isinstance(value, dict) and value:
            stack += [(f"{key}.{k}", v) for k, v in reversed(value.items())]
        elif isinstance(value, list) and value:
            stack += [(key, v) for v in reversed(value)]
        else:
            yield key, value


def targets(container: Any) -> list[str]:
    """Names in a list of references, which may be text holding that list, nested lists, or a single name."""
    opened = _opened(container)
    if opened is None:
        return [container] if isinstance(container, str) and container else []
    out, stack = [], [opened]
    while stack:
        x = stack.pop()
        if isinstance(x, list):
            stack += reversed(x)
        elif isinstance(x, dict):
            stack += [x["name"]] if "name" in x else list(x)[::-1]
        elif x is not None:
            out.append(str(_text(x)))
    return out


class _Columns:
    """Collects (rep, def, value) per leaf path of one record."""

    def __init__(self) -> None:
        self.by_path: dict[str, tuple[int, list[int], list[int], list[str | None]]] = {}

    def add(self, path: str, max_rep: int, rep: int, level: int, value: str | None) -> None:
        column = self.by_path.setdefault(path, (max_rep, [], [], []))
        column[1].append(rep)
        column[2].append(level)
        column[3].append(value)

    def rows(self) -> list[dict]:
        return [{"path": p, "max_rep": m, "reps": r, "defs": d, "vals": v} for p, (m, r, d, v) in self.by_path.items()]


def shred_value(value: Any, more: bool = True) -> list[dict]:
    """Columns of one parsed payload; without ``more`` those of entities and children only.

    The repeated ancestors are documents (level 1), entities (2), then parameters, members or requirements (3)
    and members within members (4 and on). A leaf's definition level is its depth of repetition plus one where
    the leaf itself is there, so an absent optional leaf is told from a null one by its level.
    """
    out = _Columns()
    for d, doc in enumerate(documents_in(value)):
        head = _opened(doc.get("document"))
        head = head if isinstance(head, dict) else {}
        for leaf in ("document_id", "title"):
            out.add(f"doc.{leaf}", 1, int(d > 0), 1 + (leaf in head), _text(head.get(leaf)))
        first_of_doc = True
        for key, entity in items(doc["entities"]):
            rep = 2 if not first_of_doc else int(d > 0)
            first_of_doc = False
            for leaf in ENTITY_LEAVES:
                v = entity.get(leaf)
                v = key if leaf == "name" and v is None else v
                out.add(f"doc.ent.{leaf}", 2, rep, 2 + (v is not None or leaf in entity), _text(v))
            for kind in ("parameters", "members"):
                _shred_children(out, f"doc.ent.{kind}", 3, rep, entity.get(kind))
            for path, rows in () if not more else (("cross_references", [(None, v) for v in targets(entity.get("cross_references"))]), ("more", list(further(entity)))):
                for i, (k, v) in enumerate(rows or [(None, None)]):
                    r = 3 if i else rep
                    out.add(f"doc.ent.{path}.value", 3, r, 4 if rows and v is not None else 3 if rows else 2, _text(v))
                    if path == "more":
                        out.add("doc.ent.more.key", 3, r, 4 if rows else 2, k)
            there = False
            for k, v in pairs(entity.get("requirements")):
                r = 3 if there else rep
                there = True
                out.add("doc.ent.requirements.key", 3, r, 4, _text(k))
                out.add("doc.ent.requirements.value", 3, r, 3 + (v is not None), _text(v))
            if not there:
                out.add("doc.ent.requirements.key", 3, rep, 2, None)
                out.add("doc.ent.requirements.value", 3, rep, 2, None)
        if first_of_doc:
            rep = int(d > 0)
            for leaf in ENTITY_LEAVES:
                out.add(f"doc.ent.{leaf}", 2, rep, 1, None)
            for kind in ("parameters", "members"):
                for leaf in CHILD_LEAVES:
                    out.add(f"doc.ent.{kind}.{leaf}", 3, rep, 1, None)
            for leaf in ("requirements.key", "requirements.value", *(("cross_references.value", "more.value", "more.key") if more else ())):
                out.add(f"doc.ent.{leaf}", 3, rep, 1, None)
    return out.rows()


def _shred_children(out: _Columns, path: str, level: int, rep: int, container: Any) -> None:
    """Write the children at ``path``; an explicit stack, since members nest to any depth.

    Every child that is there gets an entry in the path below it, also where it has no children itself: the
    k-th run of entries of a path belongs to the k-th child that is there one path up.
    """
    stack: list[tuple[int, int, Any]] = [(level, rep, container)]
    while stack:
        lv, r, holder = stack.pop()
        at = nested(path, lv)
        if isinstance(holder, tuple):  # one child, already opened
            key, body = holder
            name = body.get("name")
            name = key if name is None else name
            for leaf in CHILD_LEAVES:
                v = name if leaf == "name" else body.get(leaf)
                out.add(f"{at}.{leaf}", lv, r, lv + (v is not None), _text(v))
            if path == "doc.ent.members":
                stack.append((lv + 1, r, body.get("members")))
            continue
        children = list(items(holder))
        if not children:
            for leaf in CHILD_LEAVES:
                out.add(f"{at}.{leaf}", lv, r, lv - 1, None)
            continue
        for i in range(len(children) - 1, -1, -1):
            stack.append((lv, r if i == 0 else lv, children[i]))


def nested(path: str, level: int) -> str:
    """Path of the leaves of members within members, by depth, so that its length does not grow with it."""
    return path if level == 3 else f"{path}({level - 2})"


def ordinals(reps: np.ndarray, level: int) -> np.ndarray:
    """For each entry the ordinal of its ancestor at ``level``, counted over the record."""
    return np.cumsum(reps <= level) - 1


def _assembled(columns: list[dict]) -> tuple[list[dict], list[dict], list[dict], list[dict]]:
    """Entity, child, reference and further value rows of one record from its columns."""
    by = {c["path"]: c for c in columns}
    if "doc.ent.name" not in by:
        return [], [], [], []

    def sequence(path: str) -> tuple[np.ndarray, np.ndarray, list]:
        c = by[path]
        return np.asarray(c["reps"], dtype=np.int64), np.asarray(c["defs"], dtype=np.int64), list(c["vals"])

    _, _, doc_ids = sequence("doc.document_id")
    _, _, titles = sequence("doc.title")
    reps, defs, names = sequence("doc.ent.name")
    doc_of = ordinals(reps, 1)
    leaves = {leaf: sequence(f"doc.ent.{leaf}")[2] for leaf in ENTITY_LEAVES}
    entities = [
        {"document_id": doc_ids[doc_of[i]], "title": titles[doc_of[i]], "entity_no": i} | {leaf: leaves[leaf][i] for leaf in ENTITY_LEAVES}
        for i in range(len(names))
        if defs[i] >= 2
    ]
    children: list[dict] = []
    for kind, root in (("parameter", "doc.ent.parameters"), ("member", "doc.ent.members")):
        path, level = root, 3
        # of each ancestor that is there one level up: its path, its number, its entity
        above: list[tuple[str | None, str, int]] = [(None, str(i), i) for i in range(len(names))]
        while f"{path}.name" in by:
            reps, defs, vals = sequence(f"{path}.name")
            parent = ordinals(reps, level - 1)
            more = {leaf: sequence(f"{path}.{leaf}")[2] for leaf in CHILD_LEAVES}
            nth = np.arange(len(reps)) - np.maximum.accumulate(np.where(reps < level, np.arange(len(reps)), 0))
            here: list[tuple[str | None, str, int]] = []
            for i, name in enumerate(vals):
                if defs[i] < level:
                    continue
                outer, outer_no, entity = above[parent[i]]
                reached = bool(name) and (level == 3 or outer is not None)
                own = (name if level == 3 else f"{outer}/{name}") if reached else None
                here.append((own, f"{outer_no}.{nth[i]}", entity))
                children.append(
                    {
                        "entity_no": entity, "entity_name": names[entity], "child_kind": kind, "child_path": own, "depth": level - 2, "child_no": here[-1][1],
                        "parent_no": outer_no, "type": more["type"][i], "direction": more["direction"][i], "description": more["description"][i], "value": None,
                    }
                )
            above, level = here, level + 1
            path = nested(root, level)
    if "doc.ent.requirements.key" in by:
        reps, defs, keys = sequence("doc.ent.requirements.key")
        _, there, vals = sequence("doc.ent.requirements.value")
        entity = ordinals(reps, 2)
        for i, key in enumerate(keys):
            if defs[i] == 4 and there[i] >= 3:
                children.append(
                    {
                        "entity_no": int(entity[i]), "entity_name": names[entity[i]], "child_kind": "requirement", "child_path": key, "depth": 1,
                        "child_no": f"{entity[i]}.{key}", "parent_no": str(entity[i]), "type": None, "direction": None, "description": None, "value": vals[i],
                    }
                )
    references, values = [], []
    for path, into in (("cross_references", references), ("more", values)) if "doc.ent.more.key" in by else ():
        reps, defs, vals = sequence(f"doc.ent.{path}.value")
        keys = sequence("doc.ent.more.key")[2] if path == "more" else None
        entity = ordinals(reps, 2)
        first = np.maximum.accumulate(np.where(reps < 3, np.arange(len(reps)), 0))
        for i, v in enumerate(vals):
            if defs[i] >= 3:
                row = {"entity_no": int(entity[i]), "entity_name": names[entity[i]]}
                into.append(row | ({"nth": int(i - first[i]), "target": v} if keys is None else {"key": keys[i], "value": v}))
    return entities, children, references, values


def shred(raw: DataFrame, more: bool = True) -> DataFrame:
    """``raw`` (record_id, payload) as one row of shredded columns per readable payload.

    Without ``more`` the columns that only ``reference_table`` and ``value_table`` need are left out.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, columns = [], []
            for record_id, payload in zip(batch["record_id"], batch["payload"]):
                try:
                    value = parse_payload(payload)
                except NotJson:
                    continue
                ids.append(record_id)
                columns.append(shred_value(value, more))
            yield pd.DataFrame({"record_id": pd.Series(ids, dtype="int64"), "columns": pd.Series(columns, dtype=object)})

    return raw.select("record_id", "payload").where("record_id is not null and payload is not null").mapInPandas(run, SHREDDED)


def _assemble(shredded: DataFrame, which: int, schema: str) -> DataFrame:
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [{"record_id": i} | row for i, columns in zip(batch["record_id"], batch["columns"]) for row in _assembled(list(columns))[which]]
            yield pd.DataFrame(rows, columns=names)

    return shredded.mapInPandas(run, schema)


def entity_table(shredded: DataFrame) -> DataFrame:
    """One row per entity, with the keys of its record and document."""
    return _assemble(shredded, 0, ENTITIES)


def child_table(shredded: DataFrame) -> DataFrame:
    """One row per parameter, member (at any depth) or requirement, with the keys of its parents."""
    return _assemble(shredded, 1, CHILDREN)


def reference_table(shredded: DataFrame) -> DataFrame:
    """One row per cross reference of an entity, in order."""
    return _assemble(shredded, 2, REFERENCES)


def value_table(shredded: DataFrame) -> DataFrame:
    """One row per further value of an entity, by dotted key: return values, headers and whatever else a record holds."""
    return _assemble(shredded, 3, VALUES)


def document_table(shredded: DataFrame) -> DataFrame:
    """One row per document of a record, straight from its two leaf columns."""
    pick = lambda leaf: F.filter("columns", lambda c: c["path"] == f"doc.{leaf}")[0]["vals"]
    both = shredded.select("record_id", F.arrays_zip(pick("document_id").alias("document_id"), pick("title").alias("title")).alias("z"))
    return both.select("record_id", F.posexplode("z").alias("doc_no", "z")).select("record_id", "doc_no", "z.document_id", "z.title")


def malformed(raw: DataFrame) -> DataFrame:
    """record_id of the payloads that are null or not exactly one JSON value."""

    @F.pandas_udf("boolean")
    def bad(payload: pd.Series) -> pd.Series:
        def check(p: str | None) -> bool:
            try:
                parse_payload(p)
            except NotJson:
                return True
            return False

        return payload.map(check)

    return raw.where(bad("payload")).select("record_id")


def found(raw: DataFrame) -> DataFrame:
    """(record_id, entity_name, child_kind, child_path), distinct."""
    named = child_table(shred(raw, more=False)).where("entity_name <> '' and child_path <> '' and (child_kind <> 'requirement' or value is not null)")
    return named.select("record_id", "entity_name", "child_kind", "child_path").distinct()
