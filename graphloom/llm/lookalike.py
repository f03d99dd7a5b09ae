"""One consistent form for text that looks the same but differs in its characters.

The corpus's own clean words, in one script each, are the vocabulary. Distinct spellings that are not ASCII walk the
trie of their shard with a weighted edit automaton: a look-alike or invisible character costs nothing, a character
that is only nearly drawn like another costs its weight, and the cheapest word within ``BUDGET`` is the canonical
spelling, at equal cost an ASCII word, then the more frequent one. So a Russian word with one Latin letter becomes the
Russian word again, where a table could only make a mixture of it, and a letter that may stand for two is read as the
corpus's words tell. Spellings that reach no word are normalized by table. Texts are then rebuilt from canonical
spellings. The weights depend on what a character is drawn as alone, so texts that look the same become the same.

Vocabulary and spellings are spread over shards by an anchor, in which all characters that weights connect are one, so
that all words a spelling can reach are in its own shard and no shard grows with the corpus. Nothing unbounded is
broadcast. Texts without foreign letters, marks or invisible characters never leave the JVM.

Defined results. Null and empty texts are left out. Blanks of any kind become a space, one for one; invisible
characters (and NUL) vanish; superscripts, circled digits and letter case stay. Rows whose texts are equal are no pair.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.charfold import INVISIBLE, _compatible, fold_char, skeleton
from graphloom.operators.skew import hot_keys, left_join_unique
from graphloom.session import materialize, small_batches

#: A spelling: letters of alphabets, digits, marks, underscores and invisible characters between them.
_SPELLING = re.compile(
    "[A-Za-z0-9_ªµºÀ-ɏɐ-ʯ̀-ͯͰ-֏Ꭰ-᏿Ḁ-῿\u2126-\u212bⱠ-ⱿꙀ-ꚟ꜠-ꟿꬰ-ꮿﬀ-ﬆ０-９Ａ-Ｚ＿ａ-ｚ"
    + re.escape(INVISIBLE)
    + "]+"
)
#: Texts of these characters alone hold ASCII spellings only, and the table is one character for one.
_PLAIN = "\t\n\r -~‐-‧\u3000-〃々-】ぁ-ゖァ-ヺー一-鿿！-／：-＠［-＾｀｛-｠"
# Characters, as drawn, that are nearly drawn like others, and what taking one for the other costs.
NEAR = {
    ("l", "I"): 0.2, ("к", "k"): 0.3, ("κ", "k"): 0.3, ("η", "n"): 0.4, ("ω", "w"): 0.4, ("υ", "u"): 0.3, ("τ", "t"): 0.5, ("т", "t"): 0.5, ("п", "n"): 0.6, ("г", "r"): 0.6,
    ("ґ", "r"): 0.6, ("ш", "w"): 0.6, ("ƒ", "f"): 0.3, ("ɩ", "i"): 0.3, ("ɭ", "l"): 0.3, ("ʏ", "y"): 0.4, ("ʜ", "H"): 0.4, ("ɴ", "N"): 0.4, ("ʀ", "R"): 0.4, ("ɪ", "I"): 0.3,
}
#: Cost up to which a word is taken as meant.
BUDGET = 0.6
#: Distinct spellings of one shard, about.
SHARD = 50_000
HOLE = "\x00"


def near_forms(near: dict[tuple[str, str], float]) -> dict[str, list[tuple[str, float]]]:
    """For each drawn character the others it may be taken for, both ways."""
    out: dict[str, list[tuple[str, float]]] = {}
    for (a, b), cost in near.items():
        out.setdefault(a, []).append((b, cost))
        out.setdefault(b, []).append((a, cost))
    return out


def anchors(near: dict[tuple[str, str], float]) -> dict[str, str]:
    """Character to the one that stands for all characters that ``near`` connects with it."""
    of: dict[str, str] = {}
    for pair in near:
        group = {of.get(c, c) for c in pair}
        least = min(group)
        of |= {c: least for c in [*of, *pair] if of.get(c, c) in group}
    return {c: a for c, a in of.items() if c != a}


@lru_cache(maxsize=65536)
def _script(ch: str) -> str:
    return unicodedata.name(ch, "?").split()[0] if ch.isalpha() else ""


def is_clean(word: str) -> bool:
    """A word that can be a canonical spelling: composed, in one script, without invisible, wide or joined forms."""
    if word.isascii():
        return True
    plain = unicodedata.is_normalized("NFC", word) and not any(c in INVISIBLE or _compatible(c) for c in word)
    return plain and len({_script(c) for c in word} - {""}) <= 1 and unicodedata.normalize("NFKC", word) == word


def cut(text: str) -> tuple[str, list[str]]:
    """The text with the table applied outside spellings and a hole for each spelling that may need a word."""
    out, spellings, at = [], [], 0
    text = text.replace(HOLE, "")
    for m in _SPELLING.finditer(text):
        out.append(skeleton(text[at : m.start()]))
        word = m.group()
        if word.isascii():
            out.append(word)
        else:
            out.append(HOLE)
            spellings.append(word)
        at = m.end()
    out.append(skeleton(text[at:]))
    return "".join(out), spellings


class Trie:
    """The clean words of a shard, by what their characters are drawn as."""

    def __init__(self, words: Iterable[tuple[str, int]], near: dict[tuple[str, str], float] = NEAR) -> None:
        self.root: dict = {}
        self.forms = near_forms(near)
        for word, n in words:
            node = self.root
            for ch in unicodedata.normalize("NFD", skeleton(word)):
                node = node.setdefault(ch, {})
            held = node.get("")
            mine = (not word.isascii(), -n, word)
            node[""] = mine if held is None else min(held, mine)

    def walk(self, spelling: str, budget: float = BUDGET) -> tuple[str, float] | None:
        """(word, cost) of the word reached at the least cost within ``budget``, None if there is none.

        States are trie nodes with their costs. Invisible characters stay where they are; every other one moves along
        what it is drawn as at no cost, and along what that is nearly drawn as at its weight.
        """
        states: dict[int, tuple[dict, float]] = {id(self.root): (self.root, 0.0)}
        for ch in unicodedata.normalize("NFC", spelling):
            for drawn in fold_char(ch):
                after: dict[int, tuple[dict, float]] = {}
                moves = [(drawn, 0.0), *self.forms.get(drawn, ())]
                for node, cost in states.values():
                    for piece, weight in moves:
                        child, total = node.get(piece), cost + weight
                        if child is not None and total <= budget and (id(child) not in after or total < after[id(child)][1]):
                            after[id(child)] = (child, total)
                states = after
        ends = [(round(cost, 6), node[""]) for node, cost in states.values() if "" in node]
        if not ends:
            return None
        cost, (_, _, word) = min(ends)
        return word, cost


def texts(entities: DataFrame) -> DataFrame:
    """(rec_id, document_id, field_name, text) of names and descriptions."""
    both = F.array(F.struct(F.lit("name").alias("f"), F.col("name").alias("v")), F.struct(F.lit("description").alias("f"), F.col("description").alias("v")))
    return (
        entities.select("rec_id", "document_id", F.explode(both).alias("x"))
        .select("rec_id", "document_id", F.col("x.f").alias("field_name"), F.col("x.v").alias("text"))
        .where("rec_id is not null and text is not null and text <> ''")
    )


def _is_plain() -> F.Column:
    return F.col("text").rlike(f"^[{_PLAIN}]*$")


def spellings_of(rows: DataFrame) -> DataFrame:
    """(spelling, looks, n) of every distinct spelling; counted per batch or task before it is shuffled."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seen: Counter[str] = Counter()
            for text in b["text"]:
                seen.update(m for m in _SPELLING.findall(text) if not (m.isascii() and m.isdigit()))
            yield pd.DataFrame({"spelling": list(seen), "looks": [skeleton(w) for w in seen], "n": list(seen.values())})

    word = F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z0-9_]*[A-Za-z_][A-Za-z0-9_]*"), 0)).alias("spelling")
    plain = rows.where(_is_plain()).select(word).select("spelling", F.col("spelling").alias("looks"), F.lit(1).cast("long").alias("n"))
    odd = rows.where(~_is_plain()).select("text").mapInPandas(run, "spelling string, looks string, n long")
    return plain.unionByName(odd).groupBy("spelling", "looks").agg(F.sum("n").alias("n"))


def canonical_spellings(spellings: DataFrame) -> DataFrame:
    """(spelling, word, cost) of every spelling that is not ASCII: its word in the vocabulary, else its form by table with null cost.

    Only words that share an anchor with such a spelling can be reached, so only those go to the tries.
    """
    of = anchors(NEAR)
    held = materialize(spellings.withColumn("anchor", F.translate("looks", "".join(of), "".join(of.values()))))
    open_ = held.where(~F.col("spelling").rlike(r"^\p{ASCII}*$")).select("anchor").distinct()
    near = materialize(held.join(open_, "anchor", "left_semi"))
    shards = max(1, -(-near.count() // SHARD))

    def run(shard: pd.DataFrame) -> pd.DataFrame:
        trie = Trie((w, n) for w, n in zip(shard["spelling"], shard["n"]) if is_clean(w))
        rows = [(s, *(trie.walk(s) or (looks, None))) for s, looks in zip(shard["spelling"], shard["looks"]) if not s.isascii()]
        return pd.DataFrame(rows, columns=["spelling", "word", "cost"])

    return near.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).groupBy("shard").applyInPandas(run, "spelling string, word string, cost double")


def canonical_texts(rows: DataFrame) -> DataFrame:
    """``rows`` of ``texts`` with their canonical text."""
    small_batches(rows.sparkSession)
    keys = ("rec_id", "document_id", "field_name", "text")
    table = {c: fold_char(c) for c in map(chr, [9, 10, 13, *range(0x2010, 0x2028), *range(0x3000, 0x3012), *range(0xFF01, 0xFF61)]) if re.match(f"[{_PLAIN}]", c)}
    table = {c: same for c, same in table.items() if same != c}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parts = [cut(t) for t in b["text"]]
            yield b.assign(frame=[p[0] for p in parts], spellings=[p[1] for p in parts])

    words = materialize(canonical_spellings(spellings_of(rows)).select("spelling", "word"))
    plain = rows.where(_is_plain()).select(*keys, F.translate("text", "".join(table), "".join(table.values())).alias("canonical"))
    framed = rows.where(~_is_plain()).select(*keys).mapInPandas(run, "rec_id long, document_id string, field_name string, text string, frame string, spellings array<string>")
    whole = framed.where(F.size("spellings") == 0).select(*keys, F.col("frame").alias("canonical"))
    open_ = framed.where(F.size("spellings") > 0)
    used = open_.select(*keys, "frame", F.posexplode("spellings").alias("at", "spelling"))
    filled = (
        left_join_unique(used, words, "spelling", hot_keys(used, "spelling"))
        .groupBy(*keys, "frame")
        .agg(F.array_sort(F.collect_set(F.struct("at", F.coalesce("word", "spelling").alias("word")))).alias("words"))
    )
    pieces = F.zip_with(F.split("frame", HOLE, -1), F.col("words.word"), lambda a, w: F.concat(a, F.coalesce(w, F.lit(""))))
    return plain.unionByName(whole).unionByName(filled.select(*keys, F.array_join(pieces, "").alias("canonical")))


def chosen(entities: DataFrame) -> DataFrame:
    """(spelling, word, cost, by_table): every spelling for which a trie gives another word than the table."""
    by_table = F.udf(skeleton)("spelling")
    picked = canonical_spellings(spellings_of(texts(entities))).where("cost is not null")
    return picked.withColumn("by_table", by_table).where("word <> by_table")


def _rows(entities: DataFrame) -> DataFrame:
    look = F.md5(F.concat_ws("\x01", "document_id", "field_name", "canonical")).alias("look")
    return materialize(canonical_texts(texts(entities).where("document_id is not null")).select("rec_id", "field_name", look, F.md5("text").alias("form")).distinct())


def _several(rows: DataFrame) -> DataFrame:
    """(look, form) of the looks with at least two different texts."""
    forms = rows.select("look", "form").distinct()
    return forms.join(forms.groupBy("look").agg(F.count("*").alias("n")).where("n > 1").select("look"), "look", "left_semi")


def classes(entities: DataFrame) -> DataFrame:
    """(rec_id, field_name, same_text, same_look): membership of every row whose text looks like a different one.

    ``same_text`` is the first row that holds its text, ``same_look`` the first of its look: linear in the rows, however many
    hold one text, and all pairs of ``found`` follow from it.
    """
    rows = _rows(entities)
    forms = rows.join(_several(rows), ["look", "form"], "left_semi").groupBy("look", "form").agg(F.min("rec_id").alias("same_text"))
    looks = forms.groupBy("look").agg(F.min("same_text").alias("same_look"))
    return rows.join(forms.join(looks, "look"), ["look", "form"]).select("rec_id", "field_name", "same_text", "same_look").distinct()


def found(entities: DataFrame) -> DataFrame:
    """(rec_id_a, rec_id_b, field_name): rows of one manual whose texts differ but look the same.

    Only looks with at least two different texts go on; their texts are paired first, then each pair of texts meets
    its rows, so that a text held by many rows is never compared with itself.
    """
    rows = _rows(entities)
    kept = _several(rows)
    pairs = kept.alias("a").join(kept.alias("b"), F.expr("a.look = b.look and a.form < b.form")).select("a.look", F.col("a.form").alias("form"), F.col("b.form").alias("other"))
    one = pairs.join(rows, ["look", "form"]).select("look", F.col("other").alias("form"), "rec_id", "field_name")
    two = one.join(rows.select("look", "form", F.col("rec_id").alias("rec_id_2")), ["look", "form"])
    return two.select(F.least("rec_id", "rec_id_2").alias("rec_id_a"), F.greatest("rec_id", "rec_id_2").alias("rec_id_b"), "field_name").where("rec_id_a <> rec_id_b").distinct()


def consistent(entities: DataFrame) -> DataFrame:
    """(rec_id, field_name, canonical) of every text that its canonical form changes."""
    return canonical_texts(texts(entities)).where("text <> canonical").select("rec_id", "field_name", "canonical")
