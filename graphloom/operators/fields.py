"""Parsers of an entity's parts: arrays of lines to structs, by higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from graphloom.functions import text as T
from graphloom.grammar import OCR, Grammar

_ITEM = "struct<name:string,direction:string,type:string,parts:array<string>>"
_TYPE = r"^类型[：:]\s*(.+)$"


def kept(lines: Column, g: Grammar = OCR) -> Column:
    """Stripped lines without noise."""
    return F.filter(F.transform(lines, T.strip), lambda s: ~T.is_noise(s, g))


def joined(lines: Column, g: Grammar = OCR) -> Column:
    """Lines as one clean text, null if nothing is left."""
    return F.nullif(T.clean_text(F.array_join(lines, " "), g), F.lit(""))


def _fold(lines: Column, opens, g: Grammar) -> Column:
    """Items of a list of lines. ``opens(acc, s)`` gives the struct(name, direction, parts) that a line opens, or null."""
    item = lambda name, direction, type_, parts: F.struct(name.alias("name"), direction.alias("direction"), type_.alias("type"), parts.cast("array<string>").alias("parts"))
    null = F.lit(None).cast("string")
    none = item(null, null, null, F.array())
    start = F.struct(F.array().cast(f"array<{_ITEM}>").alias("done"), none.alias("cur"))

    def step(acc: Column, s: Column) -> Column:
        return T.let(opens(acc["cur"], s), lambda new: taken(acc["done"], acc["cur"], new, s))

    def taken(done: Column, cur: Column, new: Column, s: Column) -> Column:
        has = cur["name"].isNotNull()
        takes_type = s.rlike(_TYPE) & (F.coalesce(cur["type"], F.lit("")) == "")
        type_ = F.when(takes_type, T.strip(F.regexp_extract(s, _TYPE, 1))).otherwise(cur["type"])
        parts = F.when(takes_type, cur["parts"]).otherwise(F.concat(cur["parts"], F.array(s)))
        opened = item(new["name"], new["direction"], null, new["parts"])
        return F.struct(
            F.when(new.isNotNull() & has, F.concat(done, F.array(cur))).otherwise(done).alias("done"),
            F.when(new.isNotNull(), opened).when(has, item(cur["name"], cur["direction"], type_, parts)).otherwise(cur).alias("cur"),
        )

    def finish(acc: Column) -> Column:
        items = F.when(acc["cur"]["name"].isNotNull(), F.concat(acc["done"], F.array(acc["cur"]))).otherwise(acc["done"])
        empty_to_null = lambda c: F.nullif(c, F.lit(""))
        return F.transform(items, lambda i: F.struct(i["name"].alias("name"), empty_to_null(i["direction"]).alias("direction"), empty_to_null(i["type"]).alias("type"), T.clean_text(F.array_join(i["parts"], " "), g).alias("description")))

    return F.aggregate(kept(lines, g), start, step, finish)


def parameters(lines: Column, g: Grammar = OCR) -> Column:
    """array<struct<name, direction, type, description>> of a parameter list.

    "[direction] name" opens one; so does a bare identifier where none is open or the open one has no text yet.
    """

    def opens(cur: Column, s: Column) -> Column:
        directed = r"(?U)^\[([^\]]+)\]\s*(\w+)"
        rest = T.strip(F.substring(s, F.length(F.regexp_extract(s, directed, 0)) + F.lit(1), F.lit(1_000_000)))
        with_direction = F.struct(F.regexp_extract(s, directed, 2).alias("name"), T.strip(F.regexp_extract(s, directed, 1)).alias("direction"), F.filter(F.array(rest), lambda x: x != "").alias("parts"))
        bare = F.struct(s.alias("name"), F.lit(None).cast("string").alias("direction"), F.array().cast("array<string>").alias("parts"))
        free = cur["name"].isNull() | (F.size(cur["parts"]) == 0)
        return F.when(s.rlike(directed), with_direction).when(free & s.rlike(r"(?U)^[a-zA-Z_]\w*$") & (F.length(s) < 40), bare)

    return _fold(lines, opens, g)


def members(lines: Column, g: Grammar = OCR) -> Column:
    """array<struct<name, type, description>> of a member list: any bare identifier opens one."""

    def opens(cur: Column, s: Column) -> Column:
        bare = F.struct(s.alias("name"), F.lit(None).cast("string").alias("direction"), F.array().cast("array<string>").alias("parts"))
        return F.when(s.rlike(r"(?U)^[a-zA-Z_]\w*(\[\d*\])?\s*$") & (F.length(s) < 60), bare)

    return F.transform(_fold(lines, opens, g), lambda i: F.struct(i["name"].alias("name"), i["type"].alias("type"), i["description"].alias("description")))


# How versions and platforms are written.
_VERSION = r"(?iU)(Windows\s+(?:Vista|XP|7|8|8\.1|10|11|Server\s+\d{4}(?:\s+R2)?)(?:\s*\[.+?\])?|在\s+Windows\s+\d+\s+.*?(?:可用|中可用)|Windows\s+\d+,?\s+版本\s+\d+)"
_PLATFORM = r"(?iU)(通用|Universal|Windows|Desktop)"


def requirements(lines: Column, g: Grammar = OCR) -> Column:
    """struct of header, library, dll, target_platform, min_server and min_client; null if all are."""
    return T.let(kept(lines, g), _required)


def _required(ls: Column) -> Column:
    every = lambda pattern: F.flatten(F.transform(ls, lambda s: F.regexp_extract_all(s, F.lit(pattern), 1)))
    first = lambda a: F.nullif(F.get(a, F.lit(0)), F.lit(""))
    versions = F.filter(F.transform(every(_VERSION), T.strip), lambda v: F.length(v) > 5)
    server = lambda v: v.contains("Server") | v.contains("服务器")
    platforms = F.filter(ls, lambda s: s.rlike(_PLATFORM) & ~s.contains("最低") & ~s.contains("受支持"))
    fields = {
        "header": first(F.filter(every(r"(?U)\b([\w\-]+\.h)\b"), lambda h: h != "Header.h")),
        "library": first(every(r"(?iU)(\w+\.lib)")),
        "dll": first(every(r"(?iU)(\w+\.dll)")),
        "target_platform": F.nullif(F.regexp_extract(F.coalesce(F.get(platforms, F.lit(0)), F.lit("")), _PLATFORM, 1), F.lit("")),
        "min_server": first(F.filter(versions, server)),
        "min_client": first(F.filter(versions, lambda v: ~server(v))),
    }
    return F.when(F.coalesce(*fields.values()).isNotNull(), F.struct(*[c.alias(k) for k, c in fields.items()]))


def _before(c: Column, position: Column) -> Column:
    """The first ``position`` characters, stripped."""
    return T.strip(F.substring(c, F.lit(1), position))


def _cut_late(text: Column, word: str) -> Column:
    """Text without ``word`` at its end, and cut where the word stands alone late in it and is not referred to."""

    def cut(t: Column) -> Column:
        before = lambda pos: F.substring(t, F.greatest(F.lit(1), pos - 5), F.least(F.lit(6), pos))
        return T.let(F.instr(t, f" {word} ") - 1, lambda pos: F.when((pos > 0) & (pos > F.length(t) * 0.7) & ~before(pos).rlike('参阅|参见|查看|详见|"'), _before(t, pos)).otherwise(t))

    return T.let(F.regexp_replace(text, rf"(?U)\s*{word}\s*$", ""), cut)


def _cut_return(text: Column) -> Column:
    """A return value's text without the part that follows it, unless the words before only refer to that part."""
    section = r"(?U)(?<!参阅|参见|查看|详见)([。\\.!])\s*(注解|备注|言论|要求)\s"

    def late(t: Column) -> Column:
        for word in ("要求", "备注", "注解", "言论"):
            t = _cut_late(t, word)
        return T.strip(F.regexp_replace(t, r"(?U)[０-９\d]\s*(备注|注解|言论)\s+", ""))

    def cut(t: Column, at: Column) -> Column:
        near = F.substring(t, F.greatest(F.lit(1), at - 6), F.least(F.lit(6), at - 1))
        return F.when(at > 0, F.when(near.rlike("参阅|参见|查看|详见|详细"), t).otherwise(_before(t, at))).otherwise(late(t))

    bare = T.strip(F.regexp_replace(text, r"(?U)(\s没有){3,}", ""))
    return T.let(bare, lambda t: T.let(F.regexp_instr(t, F.lit(section)), lambda at: cut(t, at)))


def return_value(lines: Column, g: Grammar = OCR) -> Column:
    """struct<type, description> of a return value; null if there is neither."""
    stop = r"^(注解|备注|言论|要求|另请参阅)"

    def cut_at(text: Column, words: str) -> Column:
        return T.let(text, lambda t: T.let(F.instr(t, words), lambda pos: F.when(pos > 0, _before(t, pos)).otherwise(t)))

    def cut(text: Column) -> Column:
        for word in ("注解", "备注", "言论"):
            for mark in ("。", "."):
                text = cut_at(text, mark + word)
        return text

    def result(type_: Column, typed_at: Column, text: Column) -> Column:
        whole = T.clean_text(F.array_join(F.filter(F.transform(lines, T.strip), lambda s: s != ""), " "), g)
        said = F.when((text == "") & (typed_at == 0), whole).otherwise(text)
        description = F.nullif(_cut_return(said), F.lit(""))
        return T.let(description, lambda d: F.when((F.size(lines) > 0) & (d.isNotNull() | type_.isNotNull()), F.struct(type_.alias("type"), d.alias("description"))))

    def typed(body: Column, tail: Column, typed_at: Column) -> Column:
        type_ = F.nullif(F.regexp_replace(T.strip(F.regexp_extract(F.get(body, typed_at - 1), _TYPE, 1)), r"[。.]+$", ""), F.lit(""))
        parts = F.concat(F.filter(body, lambda s, i: (i + 1) != typed_at), F.filter(F.array(F.coalesce(tail, F.lit(""))), lambda x: x != ""))
        return T.let(cut(T.clean_text(F.array_join(parts, " "), g)), lambda text: result(type_, typed_at, text))

    def divided(ls: Column, at: Column) -> Column:
        last = F.get(ls, at - 1)
        body = F.when(at > 0, F.slice(ls, F.lit(1), at - 1)).otherwise(ls)
        tail = F.when((at > 0) & ~last.rlike(stop), T.part_at_end(last, g)["before"])
        return T.let(body, lambda b: T.let(F.array_position(F.transform(b, lambda s: s.rlike(_TYPE)), True).cast("int"), lambda typed_at: typed(b, tail, typed_at)))

    ends = lambda ls: F.array_position(F.transform(ls, lambda s: s.rlike(stop) | T.part_at_end(s, g).isNotNull()), True).cast("int")
    return T.let(kept(lines, g), lambda ls: T.let(ends(ls), lambda at: divided(ls, at)))
