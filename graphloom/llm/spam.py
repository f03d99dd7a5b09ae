"""Keyword-stuffed pages, link lists and tag lists, told from sentences by thresholds calibrated per language.

Each document is cut into units (lines; long lines into sentences), and each unit is prose, code, a lone
identifier, a link, or bare words without function words. The document's features are the shares of these kinds,
the share of its most frequent word, its most frequent pair of words per sentence, the share of repeated lines,
the separators per word and the share of link text. A short honest opening changes shares little.

Every threshold follows the language's own documents of sentences: shares of a text are held against the point halfway
between what all but a twentieth of these reach and the whole, shares of single words and pairs and the pairs per sentence against
twice what all but a hundredth reach, separators against what all but a tenth reach, prose against half of what all but a twentieth keep.
A language with fewer than ``ENOUGH`` such texts takes the thresholds of all languages together, and only a corpus
with fewer takes ``FLOORS``. Copies count once and suspected spam not at all, so that spam cannot raise its own
threshold. In a language whose function words are not known, units that end as a sentence count as prose.

A page is a list if its share of bare words and links is over the threshold, its prose under it, and any other measure over it; it is keyword
stuffing if one pair of words is both too frequent and too frequent per sentence.

Features are computed where the documents are; only quantiles per language, a handful of rows, are gathered.
Defined results. Null, empty and blank texts are no cases, nor is a list of fewer than ``ITEMS`` items or a pair met fewer than ``REPEATS`` times.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.session import materialize, small_batches

#: Least number of items of a list (units, separators and times its most frequent word is met) and of repeats of a pair of words.
ITEMS, REPEATS = 5, 3
#: Thresholds come from texts of at least so many characters and this share of prose, if there are so many of them.
LONG, SENTENCES, ENOUGH = 60, 0.5, 50
#: Thresholds where a corpus has fewer; a text over these two is suspected and takes no part in calibration.
FLOORS = {"listed": 0.55, "prose": 0.35, "linked": 0.5, "repeated": 0.5, "top_word": 0.15, "separators": 0.12, "pair_share": 0.08, "stuffed": 1.2}
SUSPECTED = ("stuffed", "pair_share")
#: Quantile of each measure that a threshold is taken from, and how: halfway to 1, times a factor.
QUANTILES = {"listed": 0.95, "linked": 0.95, "repeated": 0.95, "prose": 0.05, "top_word": 0.99, "pair_share": 0.99, "stuffed": 0.99, "separators": 0.9}
HALFWAY, FACTOR = ("listed", "linked", "repeated"), {"prose": 0.5, "top_word": 2.0, "pair_share": 2.0, "stuffed": 2.0, "separators": 1.0}
SIGNS = ("linked", "repeated", "top_word", "pair_share", "stuffed", "separators")
EVERY = "*"
# Function words.
FUNCTION_WORDS = {
    "en": "the a an of to in is are be that it its and or not for on by with as when if before after from which at this has have may must can does do your you we was were but only so one both their",
    "fr": "le la les de des du un une est sont et à au aux que qui dans pour par ne pas il faut doit avant chaque jamais avec sur d l",
    "ru": "и в не на с по для что при о из к от до или как если нужно можно перед это его она они но же бы",
    "de": "der die das und ist nicht ein eine zu den von mit für auf dem wird werden im sich als auch bei",
    "es": "el la los las de del y es que en un una por para con no se al como más su",
}
_OF = {w: lang for lang, words in FUNCTION_WORDS.items() for w in words.split()}
#: Ideographs of function words that stand alone.
_ZH_ALONE = set("的了是在把被并请若则但不与从为以这其将已对有由后且该每都要会")
_ZH = re.compile("的|了|是|在|把|被|并|请(?!求)|若|则|但|不|与|从|为|以|必须|应当|这|其|用于|将|已|对(?!齐)|有|和(?!.?$)|由|后|且|该|每|都|要|怎样|如何|会(?!话)")
_URL = re.compile(r"(?:https?://|www\.)[^\s\"<>)\]]+|<a\s[^>]*>|</a>", re.I)
_WORD = re.compile(r"[A-Za-zÀ-ɏЀ-ӿ][A-Za-zÀ-ɏЀ-ӿ0-9_'-]*|[一-鿿]|\d+")
_TOKEN = re.compile(r"[A-Za-zÀ-ɏЀ-ӿ_][A-Za-zÀ-ɏЀ-ӿ0-9_-]+|[一-鿿]")
_CODE = re.compile(r"[{}]|==|!=|\+=|->|&\w|\w\(|;\s*$|^\s*(?:#include|//|/\*|\*)|0x")
_NAME = re.compile(r"^[\W_]*(?:[A-Z][a-z]+(?:[A-Z][a-z0-9]+)+\d*|[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)+|[a-z]{1,4}[A-Z]\w+|[A-Z0-9_]{4,})(?:\(\))?[\W_]*$")
_LINE = re.compile(r"\r\n|\r|\n|\t")
_SENTENCE = re.compile(r"(?<=[。！？])|(?<=[.!?])\s+")
_SPLIT = re.compile(r"[。！？!?]|\.\s|\n")
_SEPARATOR = re.compile(r"[|,;/·•、，；#※>»\n\t]|[：:]\s?$")
_ENDED = re.compile(r"[.!?。！？][\"')）」』]?\s*$")
FEATURES = "doc_id long, text_hash long, language string, n long, prose double, listed double, linked double, top_word double, pair_share double, stuffed double, repeated double, separators double, items int"


def units(text: str) -> Iterator[str]:
    """Lines of the text, those over 200 characters cut at sentence ends."""
    for line in _LINE.split(text):
        if len(line) <= 200:
            yield line
        else:
            yield from _SENTENCE.split(line)


def kind(unit: str) -> str:
    """What one unit is: prose, code, name, link or bare; empty if it has no word.

    A unit of words without known function words is still prose if it ends as a sentence and is no enumeration.
    """
    links = _URL.findall(unit)
    rest = _URL.sub(" ", unit) if links else unit
    words = _WORD.findall(rest.lower())
    if links and len(words) <= 6:
        return "link"
    if not words:
        return ""
    functional = len(_ZH.findall(rest)) + sum(map(_OF.__contains__, words))
    if len(words) >= 4 and functional >= max(1, 0.04 * len(words)):
        return "prose"
    if _CODE.search(rest):
        return "code"
    if links:
        return "link"
    if len(words) >= 6 and _ENDED.search(rest) and len(_SEPARATOR.findall(rest)) < 0.3 * len(words):
        return "prose"
    return "name" if _NAME.match(unit) else "bare"


def language(text: str) -> str:
    """Language by script and function words; "und" where neither tells."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    within = lambda lo, hi: int(np.count_nonzero((codes >= lo) & (codes <= hi)))
    zh, ja, ru = within(0x4E00, 0x9FFF), within(0x3040, 0x30FF), within(0x400, 0x4FF)
    total = zh + ja + ru + within(0x41, 0x5A) + within(0x61, 0x7A) + within(0xC0, 0x24F)
    if not total:
        return "und"
    if zh + ja > 0.15 * total:
        return "ja" if ja > 0.3 * (zh + ja) else "zh"
    if ru > 0.3 * total:
        return "ru"
    words = re.findall(r"[^\W\d_]+", text)
    votes = Counter(_OF[w] for w in words if w in _OF).most_common(1)
    return votes[0][0] if votes and votes[0][1] >= max(3, 0.04 * len(words)) else "und"


def features(text: str) -> tuple:
    """(language, n, prose, listed, linked, top_word, pair_share, stuffed, repeated, separators, items)."""
    chars: Counter[str] = Counter()
    lines: Counter[str] = Counter()
    items = 0
    for u in units(text):
        u = u.strip()
        if u:
            what = kind(u)
            chars[what] += len(u)
            lines[u] += 1
            items += what in ("bare", "link")
    n = sum(chars.values())
    if not n:
        return "und", 0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0
    plain = _URL.sub(" ", text)
    tokens = _TOKEN.findall(plain.lower())
    tops = Counter(w for w in tokens if len(w) > 1 and w not in _OF).most_common(1)
    dull = [w in _OF or w in _ZH_ALONE for w in tokens]
    pairs = Counter((a, b) for a, b, x, y in zip(tokens, tokens[1:], dull, dull[1:]) if not (x or y)).most_common(1)
    sentences = sum(len(s.strip()) > 3 for s in _SPLIT.split(text))
    top, pair = (tops[0][1] if tops else 0), (pairs[0][1] if pairs else 0)
    many, whole, separators = max(1, len(tokens)), sum(lines.values()), len(_SEPARATOR.findall(text))
    return (
        language(plain), n, chars["prose"] / n, (chars["bare"] + chars["link"]) / n, chars["link"] / n, top / many, pair / max(1, len(tokens) - 1),
        pair / max(1, sentences) if pair >= REPEATS else 0.0, 1 - len(lines) / max(1, whole), separators / many, items + separators + top,
    )


def document_features(docs: DataFrame) -> DataFrame:
    """FEATURES of every document that has a text."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in FEATURES.split(", ")]
        for b in batches:
            yield pd.DataFrame([(i, h, *features(t)) for i, h, t in zip(b["doc_id"], b["text_hash"], b["text"])], columns=names)

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").where("doc_id is not null and text is not null and text <> ''").mapInPandas(run, FEATURES)


def thresholds(held: DataFrame) -> DataFrame:
    """(language, n_docs, at_...): the calibrated thresholds of each language with enough texts, and of ``EVERY`` one together."""
    sure = F.lit(True)
    for c in SUSPECTED:
        sure = sure & (F.col(c) >= FLOORS[c])
    texts = held.where((F.col("n") >= LONG) & (F.col("prose") >= SENTENCES) & ~sure).dropDuplicates(["text_hash"]).withColumn("language", F.explode(F.array("language", F.lit(EVERY))))

    def at(c: str) -> Column:
        q = F.percentile_approx(c, QUANTILES[c], 10_000)
        return ((1 + q) / 2 if c in HALFWAY else q * FACTOR[c]).alias(f"at_{c}")

    return texts.groupBy("language").agg(F.count("*").alias("n_docs"), *[at(c) for c in QUANTILES]).where(F.col("n_docs") >= ENOUGH)


def scored(docs: DataFrame) -> DataFrame:
    """Features of every document with its thresholds and the kind of spam it is, if any.

    A language is one of at most eight values, so there are no more than nine rows of thresholds.
    """
    held = materialize(document_features(docs))
    known = {r["language"]: r for r in thresholds(held).collect()}
    common = known.get(EVERY, {f"at_{c}": v for c, v in FLOORS.items()})

    def at(c: str) -> Column:
        own = [F.when(F.col("language") == language, F.lit(r[f"at_{c}"])) for language, r in known.items() if language != EVERY]
        return F.coalesce(*own, F.lit(common[f"at_{c}"]))

    joined = held.withColumns({f"at_{c}": at(c) for c in QUANTILES})
    over = lambda c: F.col(c) >= F.col(f"at_{c}")
    sign = F.lit(False)
    for c in SIGNS:
        sign = sign | over(c)
    listed = over("listed") & (F.col("prose") <= F.col("at_prose")) & sign & (F.col("items") >= ITEMS)
    which = F.when(listed & (F.col("linked") >= 0.5), "links").when(listed, "list").when(over("stuffed") & over("pair_share") & (F.col("stuffed") > 0), "keywords")
    return joined.withColumn("why", which)


def found(docs: DataFrame) -> DataFrame:
    """doc_id of the pages made of repeated keywords, links or tags."""
    return scored(docs).where("why is not null").select("doc_id").distinct()


def report(docs: DataFrame) -> DataFrame:
    """Documents and spam pages per detected language and kind."""
    return scored(docs).groupBy("language", F.coalesce("why", F.lit("none")).alias("why")).agg(F.count("*").alias("n_docs"))
