"""Reviewers' answers, free text that should hold one JSON object, as structs.

A text that is one JSON object is taken as it is. Anything else is read by a tolerant reader: one pass over its tokens
that keeps a stack of open objects and lists, does without commas, closing brackets and quotes around keys, takes a
quote within a text for a part of it unless something that ends a value follows (or none does before the end), and starts at the first brace whose
object holds a field of an answer. Fences and prose around the object are never looked at. Where a text breaks off
within a value, that value is lost; the edits of such an answer must have the fields they need, close to their kind.

Built-in functions cannot do this, so one Arrow-batched function does; everything around it is a plan.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.grammar import EDITS

OP = "struct<op:string,field:string,value:string,target:string,edge_type:string,name:string,entity_type:string,description:string,reason:string,target_id:string>"
RESPONSE = f"struct<verdict:string,confidence:double,summary:string,operations:array<{OP}>>"
_FIELDS = ("op", "field", "value", "target", "edge_type", "name", "entity_type", "description", "reason", "target_id")
_VERDICTS = ("keep", "delete", "merge")
# Characters after the start of a broken answer's edit in which its fields count, and the summary of an
# answer that cannot be read.
REACH = 420
UNREADABLE = "解析失败"
#: Fields without which an edit of a broken answer is none.
_NEEDED = {"update_field": ("field", "value"), "add_edge": ("target",), "delete_edge": ("target",), "add_node": ("name",), "merge_into": ("target_id",)}
_THOUGHTS = re.compile(r"<think>.*?</think>", re.S)
_TOKEN = re.compile(
    r"""\s*(?:(?P<mark>[{}\[\]:,])
    |"(?P<text>(?:[^\\]|\\.)*?)"(?=\s*(?:[,}\]:]|$))
    |"(?P<short>[^"\\]*(?:\\.[^"\\]*)*)"
    |(?P<number>-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)
    |(?P<word>[^\W\d]\w*)"?
    |(?P<open>")
    |(?P<stray>\S))""",
    re.S | re.X,
)
_WORDS = {"true": True, "false": False, "null": None}


def _unquoted(body: str) -> str:
    """A text's characters without its escapes; what is no escape stays."""
    try:
        return json.loads(f'"{body}"', strict=False)
    except ValueError:
        return body


class Reader:
    """One tolerant pass over ``text`` from the brace at ``at`` to the end of its object.

    ``found`` is the object, ``broken`` tells that something within it was lost, ``span`` gives for each object read the
    place where it started and where each of its fields ended.
    """

    def __init__(self, text: str, at: int) -> None:
        self.found: dict = {}
        self.broken = False
        self.span: dict[int, tuple[int, dict[str, int]]] = {id(self.found): (at, {})}
        self._open: list[Any] = [self.found]
        self._key: list[str | None] = [None]
        self.end = at + 1
        while self._open and (m := _TOKEN.match(text, self.end)):
            self.end = m.end()
            self._take(m, m.lastgroup or "", text)

    def _take(self, m: re.Match, kind: str, text: str) -> None:
        token = m.group(kind)
        self.broken |= kind in ("open", "stray", "short")
        if kind == "open":
            self.end = len(text)
        elif kind == "stray":
            return
        elif kind != "mark":
            names = isinstance(self._open[-1], dict) and self._key[-1] is None
            if names:
                self._key[-1] = token
            else:
                self._put(_unquoted(token) if kind in ("text", "short") else json.loads(token) if kind == "number" else _WORDS.get(token, token))
        elif token in "{[":
            value: Any = {} if token == "{" else []
            self.span[id(value)] = (m.start(kind), {})
            self._put(value)
            self._open.append(value)
            self._key.append(None)
        elif token in "}]":
            closes = dict if token == "}" else list
            while self._open and any(isinstance(x, closes) for x in self._open):
                self._key.pop()
                if isinstance(self._open.pop(), closes):
                    break
        elif token == ",":
            self._key[-1] = None

    def _put(self, value: Any) -> None:
        holder, key = self._open[-1], self._key[-1]
        if isinstance(holder, list):
            holder.append(value)
        elif key is not None:
            holder[key] = value
            self.span[id(holder)][1][key] = self.end
            self._key[-1] = None

    def edits(self) -> list[dict]:
        """The edits; of a broken answer those that have what they need within ``REACH``."""
        listed = self.found.get("operations")
        edits = [o for o in (listed if isinstance(listed, list) else []) if isinstance(o, dict)]
        if not self.broken:
            return edits
        near = []
        for o in edits:
            start, ends = self.span[id(o)]
            kept = {k: v for k, v in o.items() if ends.get(k, 0) - start <= REACH}
            if all(k in kept for k in ("op", *_NEEDED.get(str(o.get("op")), ()))):
                near.append(kept)
        return near


def read(text: str | None, wanted: tuple[str, ...] = ("verdict", "confidence", "summary", "operations")) -> dict | None:
    """The object an answer holds, None if no object in it has a ``wanted`` field."""
    body = _THOUGHTS.sub("", text or "").strip().lstrip("\ufeff").strip()
    try:
        whole = json.loads(body)
    except (ValueError, RecursionError):
        whole = None
    if isinstance(whole, dict):
        return whole
    at = body.find("{")
    named = [i for i in (body.find(f'"{k}"', 0, at if at >= 0 else len(body)) for k in wanted) if i >= 0]
    if named:  # the first brace is missing
        body, at = "{" + body[min(named) :], 0
    while at >= 0:
        r = Reader(body, at)
        if any(k in r.found for k in wanted):
            return r.found | ({"operations": r.edits()} if "operations" in r.found else {})
        at = body.find("{", max(at + 1, r.end - 1) if not r.found else at + 1)
    return None


def _as_text(v: Any) -> str | None:
    return v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False)


def _sure(v: Any) -> float:
    try:
        return max(0.0, min(1.0, float(v)))
    except (TypeError, ValueError):
        return 0.5


def parse(text: str | None) -> dict | None:
    """One answer as a RESPONSE, None if it cannot be read at all: a known verdict (else keep), a confidence within
    0..1 (0.5 if it is no number), known edits only."""
    answer = read(text)
    if answer is None:
        return None
    verdict, listed = answer.get("verdict", "keep"), answer.get("operations")
    edits = [{f: _as_text(o.get(f)) for f in _FIELDS} for o in (listed if isinstance(listed, list) else []) if isinstance(o, dict) and o.get("op") in EDITS]
    return {"verdict": verdict if verdict in _VERDICTS else "keep", "confidence": _sure(answer.get("confidence", 0.5)), "summary": str(answer.get("summary", "")), "operations": edits}


def parse_winner(text: str | None) -> str | None:
    """"A" or "B" of a comparison's answer, None if it names neither."""
    winner = str((read(text, ("winner",)) or {}).get("winner", "")).strip().upper()
    return winner if winner in ("A", "B") else None


def parsed(answers: DataFrame, column: str = "raw") -> DataFrame:
    """``answers`` with ``response``; an answer that cannot be read keeps its entity, with confidence 0."""

    @F.pandas_udf(RESPONSE)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = [parse(t) or {"verdict": "keep", "confidence": 0.0, "summary": UNREADABLE, "operations": []} for t in texts]
            yield pd.DataFrame(rows, columns=["verdict", "confidence", "summary", "operations"])

    return answers.withColumn("response", run(column))
