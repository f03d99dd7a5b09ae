"""Scalar text functions of the extraction, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from graphloom.grammar import KNOWN_TYPES, OCR, TYPE_WORDS, Grammar

ALLCAPS = r"[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)+"
# Dates that mark a line as metadata.
_DATED = r"项目\d{4}/\d{2}/\d{2}"
_META = r"(?U)^(?:(?:IOCTL|枚举|函数|结构|回调|接口|方法|宏)\s*（[\w\.]+）" + _DATED + r"|[\w\.]+\s+标头" + _DATED + ")"
ARTICLE_META = r"(?U)^.{0,30}项目\s*\d{4}/\d{2}/\d{2}"
TRAILING_NAME = r"(?U)[。\.]\s+(" + ALLCAPS + r")\s*$"


def let(c: Column, body: Callable[[Column], Column]) -> Column:
    """``body(c)`` with ``c`` evaluated once, however often ``body`` uses it: plans stay linear in size."""
    return F.get(F.transform(F.array(c), body), F.lit(0))


def strip(c: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def is_noise(c: Column, g: Grammar = OCR) -> Column:
    """Blank, or page furniture; null counts as blank."""
    s = strip(F.coalesce(c, F.lit("")))
    return (s == "") | s.isin(*g.noise_lines) | s.rlike(g.noise_pattern)


def is_meta(c: Column) -> Column:
    """A line of kind, header and date."""
    return strip(c).rlike(_META)


def section_type(c: Column, g: Grammar = OCR) -> Column:
    """Type of the section that a line opens, null if it opens none."""
    if not g.sections:
        return F.lit(None).cast("string")
    return F.element_at(F.create_map(*[F.lit(x) for pair in g.sections for x in pair]), strip(c))


def header_name(c: Column) -> Column:
    """Header file whose section a line opens, else null."""
    return F.nullif(F.regexp_extract(strip(c), r"(?U)^(\w[\w\-]*\.h)\s+标头", 1), F.lit(""))


def part_opened(s: Column, g: Grammar = OCR) -> Column:
    """struct(key, rest) of the part a stripped line opens at its start, null if none."""

    def opens(marker: str, key: str) -> Column:
        rest = strip(F.substring(s, len(marker) + 1, 1_000_000))
        return F.when((s == marker) | (s.startswith(marker) & rest.rlike(r"^[\[（(：:类返无没\p{Lu}]")), F.struct(F.lit(key).alias("key"), rest.alias("rest")))

    return F.coalesce(*[opens(m, k) for m, k in g.parts])


def part_at_end(s: Column, g: Grammar = OCR) -> Column:
    """struct(key, before) of the part a stripped line opens at its end, null if none."""
    words = "|".join(m.replace("+", r"\+") for m in dict.fromkeys(["注解", "备注", "言论", *(m for m, _ in g.parts)]))
    pattern = rf"(?U)^(.*?[。.!）)])\s*({words})\s*$"
    key = F.element_at(F.create_map(*[F.lit(x) for pair in g.parts for x in pair]), F.regexp_extract(s, pattern, 2))
    return F.when(s.rlike(pattern), F.struct(key.alias("key"), strip(F.regexp_extract(s, pattern, 1)).alias("before")))


def is_stop_word(name: Column, g: Grammar = OCR) -> Column:
    """A capitalised word that is no name."""
    return name.isin(*g.stop_words)


def name_opened(s: Column, camel: Column, g: Grammar = OCR) -> Column:
    """struct(name, rest) of the entity a stripped line opens, null if none; ``camel`` allows camel-case names."""

    def found(pattern: str, keep) -> Column:
        name = F.regexp_extract(s, pattern, 1)
        rest = strip(F.substring(s, F.length(F.regexp_extract(s, pattern, 0)) + F.lit(1), F.lit(1_000_000)))
        return F.when(s.rlike(pattern) & keep(name), F.struct(name.alias("name"), rest.alias("rest")))

    after = r"(?=\s|$|[一-鿿])"
    return F.coalesce(
        found(rf"^({ALLCAPS})(?![a-z])", lambda n: F.length(n) >= g.min_name),
        found(rf"(?U)^(_[a-zA-Z][a-zA-Z0-9]+){after}", lambda n: F.lit(True)),
        found(r"(?U)^([A-Za-z_][A-Za-z0-9_]+)\s*\(", lambda n: ~is_stop_word(n, g) & (F.length(n) >= 4)),
        found(rf"(?U)^([A-Z][a-z][a-zA-Z0-9]*){after}", lambda n: camel & ~is_stop_word(n, g) & (F.length(n) >= 4)),
    )


def clean_text(c: Column, g: Grammar = OCR) -> Column:
    """Text without furniture, cut where another part begins, white space evened out."""
    c = F.regexp_replace(c, g.text_noise, "")
    for end in g.text_ends:
        c = F.regexp_replace(c, "(?U)" + end, "")
    c = let(c, lambda t: let(F.regexp_instr(t, F.lit(TRAILING_NAME)), lambda at: F.when(at > 0, F.substring(t, F.lit(1), at)).otherwise(t)))
    c = F.regexp_replace(strip(F.regexp_replace(c, r"(?U)\s+", " ")), r"^[- ：:]+", "")
    return F.regexp_replace(c, r"(?U)\s+是\s+否\s*$", "")


def infer_type(name: Column, current: Column, g: Grammar = OCR) -> Column:
    """The section's type, or where that is unknown the type the name's form tells."""
    rules = F.coalesce(*[F.when(name.rlike(p), F.lit(t)) for p, t in g.type_rules], F.lit("unknown"))
    return F.when(current != "unknown", current).otherwise(rules)


def confidence(name: Column, description: Column, entity_type: Column, header: Column, syntax: Column, detailed: Column, returns: Column) -> Column:
    """How complete an entity is, in steps of 0.05 from 0 to 1. Sums hundredths, so the result is exact."""
    has = lambda c: F.coalesce(c, F.lit("")) != ""
    n = F.length(F.coalesce(description, F.lit("")))
    points = (
        F.when(name.rlike(rf"^{ALLCAPS}$"), 30).when(name.startswith("_"), 20).when(name.rlike("^[A-Z][a-z]"), 15).otherwise(0)
        + F.when(n > 50, 20).when(n > 20, 10).otherwise(0)
        + F.when(entity_type != "unknown", 15).otherwise(0)
        + F.when(has(header), 10).otherwise(0)
        + F.when(has(syntax), 10).otherwise(0)
        + F.when(F.coalesce(detailed, F.lit(False)), 10).otherwise(0)
        + F.when(F.coalesce(returns, F.lit(False)), 5).otherwise(0)
    )
    return F.least(points, F.lit(100)).cast("int") / F.lit(100.0)


def truncate(c: Column, n: int) -> Column:
    """One line of at most ``n`` characters, dots where it was cut."""
    one = strip(F.replace(F.coalesce(c, F.lit("")), F.lit("\n"), F.lit(" ")))
    return F.when(F.length(one) > n, F.concat(F.substring(one, 1, n), F.lit("..."))).otherwise(one)


def file_meta(file_name: Column) -> Column:
    """struct(domain, topic, ocr_time) that a scan's file name tells; empty strings where it tells nothing."""
    pattern = r"^\[OCR\]_windows-(.+?)_(\d{4})(\d{2})(\d{2})_(\d{2})(\d{2})"
    part = lambda i: F.regexp_extract(file_name, pattern, i)
    raw, pieces = part(1), F.split(part(1), "-_")
    two = F.size(pieces) == 2
    has_dash = raw.contains("-")
    domain = F.when(two, pieces[0]).when(has_dash, F.regexp_extract(raw, r"^(.*)-[^-]*$", 1)).otherwise(raw)
    topic = F.when(two, F.get(pieces, F.lit(1))).when(has_dash, F.regexp_extract(raw, r"-([^-]*)$", 1)).otherwise("")
    time = F.concat(part(2), F.lit("-"), part(3), F.lit("-"), part(4), F.lit("T"), part(5), F.lit(":"), part(6), F.lit(":00"))
    known = file_name.rlike(pattern)
    empty = F.lit("")
    return F.struct(F.when(known, domain).otherwise(empty).alias("domain"), F.when(known, topic).otherwise(empty).alias("topic"), F.when(known, time).otherwise(empty).alias("ocr_time"))


def output_name(file_name: Column) -> Column:
    """Name of the document written for a scan."""
    bare = F.replace(F.replace(F.replace(file_name, F.lit("[OCR]_windows-"), F.lit("")), F.lit(".p.txt"), F.lit("")), F.lit(".txt"), F.lit(""))
    return F.concat(bare, F.lit(".json"))


def normalize_type(c: Column) -> Column:
    """A type of the closed list; unknown for others."""
    t = F.lower(strip(F.coalesce(c, F.lit(""))))
    t = F.when(t == "", F.lit("unknown")).when(t == "struct", F.lit("structure")).when(t == "enumvalue", F.lit("enum_value")).otherwise(t)
    return F.when(t.isin(*KNOWN_TYPES), t).otherwise("unknown")


def type_tokens(c: Column) -> Column:
    """C identifiers in a type, without keywords."""
    words = F.split(strip(F.replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)[\s*]+", " "), F.lit(","), F.lit(" "))), r"(?U)\s+")
    bare = F.transform(words, lambda w: F.regexp_replace(w, r"^[()\[\]{};]+|[()\[\]{};]+$", ""))
    return F.filter(bare, lambda w: w.rlike("^[A-Za-z_][A-Za-z0-9_]*$") & ~F.lower(w).isin(*TYPE_WORDS))


def fixed(c: Column, digits: int) -> Column:
    """A number below 1 in size with ``digits`` decimals, rounded by its exact binary value.

    ``format_string`` rounds the shortest decimal form instead, which differs where that ends in a 5. The number times
    2^60 is a whole number (from 0.01 on), so the rest of the work is exact in decimals.
    """
    unit = F.lit(1 << 60).cast("decimal(20,0)")

    def shown(q: Column) -> Column:
        return let(q % unit, lambda r: let(((q - r) / unit).cast("long"), lambda n: n + F.when((r * 2 > unit) | ((r * 2 == unit) & (n % 2 == 1)), 1).otherwise(0)))

    scaled = (F.abs(c) * F.lit(float(1 << 60))).cast("long").cast("decimal(20,0)") * F.lit(10**digits).cast("decimal(7,0)")
    whole = let(scaled, shown)
    text = let(whole, lambda n: F.concat(F.floor(n / 10**digits).cast("string"), F.lit("."), F.lpad((n % 10**digits).cast("string"), digits, "0")))
    return F.when(c < 0, F.concat(F.lit("-"), text)).otherwise(text)


def short_hash(c: Column) -> Column:
    """First 12 hexadecimal digits of the SHA-256 of a text."""
    return F.substring(F.sha2(c, 256), 1, 12)
