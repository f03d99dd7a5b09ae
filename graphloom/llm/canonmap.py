"""Freely entered values mapped to a reference list by a symmetric-delete dictionary.

Every term is indexed under each string that deleting up to two characters from it gives. A value is looked up the same
way, so any term within that edit distance is met without comparing it with all terms; what is met is ranked by how
much of the value the form is (all of it, a part, a word, a compound), then by weighted Damerau-Levenshtein distance,
then by how often the entry itself occurs in the corpus. Misses are reported as -1.

Terms are learned, not listed. The list gives its labels in both languages and their beginnings that no other entry
shares (``func``). The corpus gives alternative names: rows of one entity mean the same, so a value that in at least
``SUPPORT`` entities stands beside a label, nearly always (``SHARE``) the same one, is a name of that entry; values that mean nothing stand
beside any label. Platform values are also looked up with the spelling of their version fields evened out.

The dictionary is broadcast after its size is checked; beyond ``max_terms`` terms the same deletes are joined by shuffle,
with the same forms, distances and ranking, so both ways give the same. Lookups run where the rows are, once per distinct value of a batch.

Defined results. Null values and values exactly equal to a label of their kind are no cases; an empty value is a
miss. Digits never count as misspelt, so a version or service pack only meets an entry with the same one. A form that is
more than two characters longer than every term meets none, and is not taken apart.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.charfold import skeleton
from graphloom.session import materialize

MISS = -1
MAX_DISTANCE = 2
#: Terms up to which the dictionary is broadcast: some tens of megabytes of deletes.
MAX_TERMS = 20_000
#: Entities in which a value must stand beside one label to be learned as its name, and the share of them all.
SUPPORT, SHARE = 4, 0.9
#: Answers a task keeps at hand.
KEPT = 50_000
#: Least letters of a label's beginning that stands for it.
SHORT = 4
_OS_NOISE = re.compile(
    r"[(\[{][^)\]}]*(?:desktop|store|apps?|only|桌面|程序|应用)[^)\]}]*[)\]}]|\bor (?:later|newer|above|higher)\b|\band (?:later|newer|above|higher)\b|及更高版本|及以上版本|及以上|或更高版本|以上|\+\s*$"
)
# Spellings of parts of a platform value, in the order of replacement.
_OS_RULES = [
    (r"_", " "),
    (r"^\s*(?:microsoft\s*|ms\b\.?)", " "),
    (r"专业版", " professional "),
    (r"(?:服务包|service\s*pack|service\s*pk|servicepack|\bsp|\bs\.p\.)\s*(?=\d)", " sp"),
    (r"(?:版本|\bversion|\bver\.?|\bv\.?)\s*(?=\d)", " "),
    (r"\b(?:professional|prof|pro)\b\.?", " professional "),
    (r"^\s*(?:windows|win|w)\b\.?\s*", "windows "),
    (r"^\s*(?:windows|win|w)(?=\d|vista|xp)", "windows "),
    (r"[,，;/()\[\]{}+_|。\-]", " "),
]


def tidy(value: str) -> str:
    """Width, blanks, case and surrounding marks evened out."""
    return re.sub(r"\s+", " ", skeleton(unicodedata.normalize("NFKC", value)).lower()).strip()


def type_forms(value: str, longest: int) -> list[tuple[int, int, str]]:
    """(rank, position, form) of a type value: all of it, its parts between separators, its words, what a lone word begins with."""
    bare = re.sub(r"\(\)$", "", re.sub(r"^[\s\W_]+|[\s\W_]+$", "", tidy(value)))
    parts = [p.strip() for p in re.split(r"[/,，、;|()\[\]（）:：]+", bare)]
    words = re.findall(r"[^\W\d_]+", bare)
    ranked = [(0, 0, bare), *((1, i, p) for i, p in enumerate(parts)), *((2, i, w) for i, w in enumerate(words) if len(words) > 1)]
    if len(words) == 1:
        ranked += [(3, -n, bare[:n]) for n in range(min(len(bare) - 1, longest), (SHORT if bare.isascii() else 1) - 1, -1)]
    every = [(r, i, y) for r, i, x in ranked for y in (x, _singular(x)) if y]
    return list({x[2]: x for x in reversed(every)}.values())[::-1]


def platform_form(value: str) -> str:
    """A platform value in the form "windows 7 sp1"."""
    t = _OS_NOISE.sub(" ", tidy(value))
    for pattern, by in _OS_RULES:
        t = re.sub(pattern, by, t)
    t = re.sub(r"(?<![\w.])(w[a-z]{3,7})(?=\d)", r"\1 ", re.sub(r"\s+", " ", t).strip(" .!"))
    t = re.sub(r"^(w[a-z]{4,7}?)(vista|xp)\b", r"\1 \2", t)
    if re.fullmatch(r"w\w* 2000", t):
        t += " professional"
    return re.sub(r"\s+", " ", t).strip(" .!")


def forms(kind: str, value: str, longest: int) -> list[tuple[int, int, str]]:
    """(rank, position, form) of a value to look up, the lowest rank first; only forms of rank below 3 may be misspelt. Terms have at most ``longest`` characters."""
    if kind != "min_client":
        return type_forms(value, longest)
    whole, even = tidy(value), platform_form(value)
    return [(0, 0, f) for f in dict.fromkeys((even, whole)) if f]


def deletes(term: str, distance: int = MAX_DISTANCE) -> set[str]:
    """The term and all strings that deleting up to ``distance`` of its characters gives; digits stay."""
    loose = [i for i, ch in enumerate(term) if not ch.isdigit()]
    out = {term}
    for k in range(1, distance + 1):
        for gone in combinations(loose, k):
            out.add("".join(ch for i, ch in enumerate(term) if i not in gone))
    return out


def keys(rank: int, form: str, longest: int) -> set[str]:
    """What a form is looked up under: its deletes, or only itself where it cannot be a misspelt term."""
    return deletes(form) if rank < 3 and form.isascii() and len(form) <= longest + MAX_DISTANCE else {form}


# Letters that are often struck or read for one another.
_NEAR = {frozenset(p) for p in ("ao", "ae", "ei", "iu", "io", "uo", "mn", "sz", "ck", "il", "rt", "nh", "vb", "ce", "uv", "gj", "qw", "as", "df", "er", "ty", "ui", "op")}


def distance(a: str, b: str, limit: float = 3.0) -> float:
    """Weighted Damerau-Levenshtein: a swap 0.7, a near letter 0.7, a doubled letter 0.6, a digit never."""
    never = 1e9
    rows = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, ch in enumerate(a, 1):
        rows[i][0] = rows[i - 1][0] + (never if ch.isdigit() else 1)
    for j, ch in enumerate(b, 1):
        rows[0][j] = rows[0][j - 1] + (never if ch.isdigit() else 1)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            gone = never if x.isdigit() else 0.6 if i > 1 and a[i - 2] == x else 1.0
            come = never if y.isdigit() else 0.6 if j > 1 and b[j - 2] == y else 1.0
            swap = 0.0 if x == y else never if x.isdigit() or y.isdigit() else 0.7 if frozenset((x, y)) in _NEAR else 1.0
            best = min(rows[i - 1][j] + gone, rows[i][j - 1] + come, rows[i - 1][j - 1] + swap)
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and x != y and not (x + y).isdigit():
                best = min(best, rows[i - 2][j - 2] + 0.7)
            rows[i][j] = best
    return rows[-1][-1]


def allowed(term: str) -> float:
    """Distance up to which a term is taken as meant, by the length of its letters."""
    n = sum(ch.isalpha() for ch in term)
    return 0.0 if n < 4 or not term.isascii() else 1.0 if n < 6 else 2.0


def far(form: str, term: str, rank: int, begins: bool) -> float | None:
    """Distance of a form from a term, None if the term is not meant; one that only ``begins`` a label is meant by a whole value."""
    if begins:
        return 0.0 if form == term and rank == 0 else None
    if form == term:
        return 0.0
    if rank >= 3 or not form.isascii():
        return None
    d = distance(form, term)
    return d if d <= min(allowed(term), allowed(form) + 0.5) else None


@dataclass
class Dictionary:
    """Symmetric-delete index of one kind's terms, each with the entries it may mean and whether it only begins their label."""

    kind: str
    terms: dict[str, set[tuple[int, bool]]]
    frequency: dict[int, int]
    index: dict[str, list[str]] = field(default_factory=dict)
    longest: int = 0

    def __post_init__(self) -> None:
        self.longest = max(map(len, self.terms), default=0)
        for term in self.terms:
            for d in deletes(term, MAX_DISTANCE if term.isascii() else 0):
                self.index.setdefault(d, []).append(term)

    def lookup(self, value: str) -> int:
        """The entry a value means, MISS if none: the least (rank, distance, position, -frequency, canon_id)."""
        best: tuple[int, float, int, int, int] | None = None
        for rank, position, form in forms(self.kind, value, self.longest):
            if best is not None and best[0] < rank:
                break
            settled = best is not None and best[:2] == (rank, 0) or any(rank == 0 or not begins for _, begins in self.terms.get(form, ()))
            near = {form} & self.terms.keys() if settled else {t for d in keys(rank, form, self.longest) for t in self.index.get(d, ())}
            for term in near:
                for c, begins in self.terms[term]:
                    d = far(form, term, rank, begins)
                    if d is not None:
                        best = min((rank, d, position, -self.frequency.get(c, 0), c), best or (9, 0.0, 0, 0, 0))
        return best[4] if best else MISS


def _singular(form: str) -> str:
    return form[:-3] + "y" if form.endswith("ies") else form[:-2] if form.endswith(("sses", "shes", "ches")) else form[:-1] if form.endswith("s") and not form.endswith("ss") else form


def spellings(kind: str, label: str, label_zh: str | None) -> list[str]:
    """The terms one entry gives: both labels, and for types the beginnings of the label."""
    if kind == "min_client":
        return [f for f in dict.fromkeys(y for x in (label, label_zh) if x for y in (platform_form(x), tidy(x))) if f]
    whole = [tidy(x) for x in (label, label_zh) if x]
    return list(dict.fromkeys(f for f in (*whole, *(w[:n] for w in whole[:1] if w.isascii() for n in range(SHORT, len(w)))) if f))


def terms_of(canon: DataFrame) -> DataFrame:
    """(kind, term, canon_id, begins) of a list; a beginning that several entries of a kind share means none of them."""

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, t, cid, t in {tidy(label), tidy(zh or "")} or k == "min_client") for cid, k, label, zh in zip(b["canon_id"], b["kind"], b["label"], b["label_zh"]) for t in spellings(k, label, zh)]
            yield pd.DataFrame(rows, columns=["kind", "term", "canon_id", "whole"])

    entries = canon.where("canon_id is not null and kind is not null and label is not null").select("canon_id", "kind", "label", "label_zh")
    spelt = entries.mapInPandas(spell, "kind string, term string, canon_id int, whole boolean")
    one = spelt.groupBy("kind", "term").agg(F.max("whole").alias("whole"), F.collect_set(F.struct("canon_id", "whole")).alias("held"))
    kept = F.filter("held", lambda h: h["whole"] | (~F.col("whole") & (F.size("held") == 1)))
    return one.select("kind", "term", F.explode(kept).alias("h")).select("kind", "term", "h.canon_id", (~F.col("h.whole")).alias("begins")).distinct()


def values(entities: DataFrame, *more: str) -> DataFrame:
    """(rec_id, field_name, value) of both fields, and the columns ``more``."""
    both = F.array(F.struct(F.lit("entity_type").alias("f"), F.col("entity_type").alias("v")), F.struct(F.lit("min_client").alias("f"), F.col("requirements.min_client").alias("v")))
    return entities.select("rec_id", *more, F.explode(both).alias("x")).select("rec_id", *more, F.col("x.f").alias("field_name"), F.col("x.v").alias("value")).where("value is not null")


def _labels(canon: DataFrame) -> DataFrame:
    return canon.where("canon_id is not null and kind is not null and label is not null").select(F.col("kind").alias("field_name"), F.col("label").alias("value"), "canon_id").distinct()


def learned(entities: DataFrame, canon: DataFrame, support: int = SUPPORT, share: float = SHARE) -> DataFrame:
    """(kind, term, canon_id, begins): values of the corpus that stand for an entry.

    Rows of one entity (manual and name) are brought together; each entity counts once for a value and a label. An entity has
    at most one label set per kind, so nothing larger than the list meets in one key.
    """

    @F.pandas_udf("string")
    def tidied(kind: pd.Series, value: pd.Series) -> pd.Series:
        codes, distinct = pd.MultiIndex.from_arrays([kind, value]).factorize()
        return pd.Series([platform_form(v) if k == "min_client" else tidy(v) for k, v in distinct], dtype=object).take(codes).reset_index(drop=True)

    held = values(entities, "document_id", "name").where("document_id is not null and name is not null").select("document_id", "name", "field_name", "value").distinct()
    labels = _labels(canon)
    sure = held.join(labels, ["field_name", "value"]).select("document_id", "name", "field_name", "canon_id").distinct()
    free = held.join(labels, ["field_name", "value"], "left_anti").withColumn("term", tidied("field_name", "value")).where("term <> ''").select("document_id", "name", "field_name", "term").distinct()
    both = free.join(sure, ["document_id", "name", "field_name"]).groupBy("field_name", "term", "canon_id").agg(F.count("*").alias("n"))
    total = both.groupBy("field_name", "term").agg(F.sum("n").alias("total"), F.max(F.struct("n", "canon_id")).alias("top"))
    return total.where((F.col("top.n") >= support) & (F.col("top.n") >= share * F.col("total"))).select(F.col("field_name").alias("kind"), "term", "top.canon_id", F.lit(False).alias("begins"))


def _terms(entities: DataFrame, canon: DataFrame) -> DataFrame:
    """(kind, term, canon_id, begins) of list and corpus; what the list says of a term holds, unless it only begins a label."""
    listed, names = terms_of(canon), learned(entities, canon)
    return listed.unionByName(names.join(listed.where("not begins").select("kind", "term").distinct(), ["kind", "term"], "left_anti")).groupBy("kind", "term", "canon_id").agg(F.min("begins").alias("begins"))


def _frequency(entities: DataFrame, canon: DataFrame) -> DataFrame:
    return values(entities).join(_labels(canon), ["field_name", "value"]).groupBy("canon_id").agg(F.count("*").alias("n"))


def dictionaries(terms: DataFrame, frequency: DataFrame, max_terms: int) -> dict[str, Dictionary] | None:
    """The dictionaries of all kinds, or None if there are more than ``max_terms`` terms."""
    rows = terms.limit(max_terms + 1).collect()
    if len(rows) > max_terms:
        return None
    counts = {r["canon_id"]: r["n"] for r in frequency.collect()}  # entries have terms, so there are no more of them
    by: dict[str, dict[str, set[tuple[int, bool]]]] = {}
    for r in rows:
        by.setdefault(r["kind"], {}).setdefault(r["term"], set()).add((r["canon_id"], r["begins"]))
    return {k: Dictionary(k, held, counts) for k, held in by.items()}


def found(entities: DataFrame, canon: DataFrame, max_terms: int = MAX_TERMS) -> DataFrame:
    """(rec_id, field_name, canon_id), distinct. ``max_terms`` bounds what is broadcast and changes no result."""
    terms, frequency = materialize(_terms(entities, canon)), _frequency(entities, canon)
    known = dictionaries(terms, frequency, max_terms)
    opened = values(entities).join(_labels(canon).select("field_name", "value").distinct(), ["field_name", "value"], "left_anti")
    if known is None:
        return _found_by_join(opened, terms, frequency)
    held = entities.sparkSession.sparkContext.broadcast(known)

    @F.pandas_udf("int")
    def meant(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        @lru_cache(KEPT)
        def one(kind: str, value: str) -> int:
            return held.value[kind].lookup(value) if kind in held.value else MISS

        for kind, value in batches:
            codes, distinct = pd.MultiIndex.from_arrays([kind, value]).factorize()
            yield pd.Series([one(k, v) for k, v in distinct], dtype="int32").take(codes).reset_index(drop=True)

    return opened.select("rec_id", "field_name", meant("field_name", "value").alias("canon_id")).distinct()


def _found_by_join(opened: DataFrame, terms: DataFrame, frequency: DataFrame) -> DataFrame:
    """The same for terms of any number: deletes of values and of terms meet in a shuffle join.

    Values are looked up once each; a value that holds many rows meets its answer by a join salted on the row key. Only the
    length of the longest term per kind reaches the driver.
    """
    salts = 32
    longest = {r["kind"]: r["n"] for r in terms.groupBy("kind").agg(F.max(F.length("term")).alias("n")).collect()}

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, d, t, c, w) for k, t, c, w in zip(b["kind"], b["term"], b["canon_id"], b["begins"]) for d in deletes(t, MAX_DISTANCE if t.isascii() else 0)]
            yield pd.DataFrame(rows, columns=["kind", "d", "term", "canon_id", "begins"])

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, v, r, i, form, d) for k, v in zip(b["field_name"], b["value"]) if k in longest for r, i, form in forms(k, v, longest[k]) for d in keys(r, form, longest[k])]
            yield pd.DataFrame(rows, columns=["kind", "value", "rank", "position", "form", "d"])

    @F.pandas_udf("double")
    def how_far(form: pd.Series, term: pd.Series, rank: pd.Series, begins: pd.Series) -> pd.Series:
        return pd.Series([far(*x) for x in zip(form, term, rank, begins)], dtype="float64")

    met = (
        opened.select("field_name", "value").distinct().mapInPandas(ask, "kind string, value string, rank int, position int, form string, d string")
        .join(terms.mapInPandas(spell, "kind string, d string, term string, canon_id int, begins boolean"), ["kind", "d"])
        .select("kind", "value", "rank", "position", "form", "term", "canon_id", "begins").distinct()
        .withColumn("far", how_far("form", "term", "rank", "begins")).where("far is not null and not isnan(far)")
        .join(frequency, "canon_id", "left")
    )
    best = met.groupBy(F.col("kind").alias("field_name"), "value").agg(F.min(F.struct("rank", "far", "position", (-F.coalesce("n", F.lit(0))).alias("f"), "canon_id"))["canon_id"].alias("canon_id"))
    spread = best.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (
        opened.withColumn("salt", F.pmod(F.xxhash64("rec_id"), F.lit(salts)).cast("int"))
        .join(spread, ["field_name", "value", "salt"], "left")
        .select("rec_id", "field_name", F.coalesce("canon_id", F.lit(MISS)).cast("int").alias("canon_id")).distinct()
    )


def misses(entities: DataFrame, canon: DataFrame) -> DataFrame:
    """Values without an entry, per field, with the number of rows that hold them."""
    missed = found(entities, canon).where(F.col("canon_id") == MISS)
    return values(entities).join(missed, ["rec_id", "field_name"], "left_semi").groupBy("field_name", "value").agg(F.count("*").alias("n_rows"))
