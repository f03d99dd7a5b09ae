"""Scanned lines repaired into continuous paragraphs.

Page furniture. A running header is a line that repeats its file's title, apart from misread characters, with or
without a page number or section name; a page number is a line of one of the usual forms, or a bare number that
stands next to a header or goes on from such a one, as many pages on as the lines between allow, by the usual length
of the file's pages (files that number their pages in marks or headers hold other bare numbers only). All are windows over a file's lines that look back only, one in either order.

Words. A hyphen at the end of a line is one where a letter stands before it and the next text line goes on with a
letter. Halves are joined before words are looked at; in a paragraph the hyphen stays where the corpus writes the word with it more often
than without.

Characters: a noisy channel. Words (parts of identifiers, single ideographs) are counted over the whole corpus, and
so are their pairs. Candidates for a word undo confusions: pairs of Latin characters, whose probabilities are estimated from the corpus by
expectation maximization, and pairs of ideographs
learned from the corpus, where one stands in a place that nearly always holds the other. An ideograph with uses of
its own may be a misread one too: its own places then keep it, the others change it. A line with candidates is
decoded by Viterbi: confusion probability times pair likelihood. A capital I within a word, which cuts it like a new part of an
identifier, is an l where that makes a word of the corpus. All counts are tables that are joined by word or
pair; none is broadcast or gathered, apart from the confusions, which are bounded by the alphabet.

Defined results. Null and blank lines carry no fault and are skipped when the next text line is sought. A file's
first line is its title and no header. Lines without a file are left out of everything that needs one. A word that is misread on
both lines it is hyphenated over is a case on both.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.operators.skew import hot_keys, left_join_unique
from graphloom.session import materialize, small_batches

# What a scanner reads in place of a character, with the probability given that it errs there that estimation starts from.
CONFUSIONS = {
    ("e", "c"): 0.2, ("t", "f"): 0.12, ("s", "5"): 0.1, ("o", "0"): 0.1, ("i", "1"): 0.1, ("l", "1"): 0.1, ("m", "rn"): 0.1, ("h", "b"): 0.1, ("O", "0"): 0.1, ("I", "1"): 0.1,
    ("rn", "m"): 0.1, ("ni", "m"): 0.02, ("nn", "m"): 0.02, ("l", "I"): 0.05, ("I", "l"): 0.05, ("E", "F"): 0.1, ("S", "5"): 0.1, ("B", "8"): 0.1, ("Z", "2"): 0.05, ("G", "6"): 0.05,
    ("g", "9"): 0.05, ("b", "6"): 0.05, ("cl", "d"): 0.05, ("d", "cl"): 0.05, ("w", "vv"): 0.05, ("vv", "w"): 0.05, ("u", "v"): 0.03, ("n", "u"): 0.03, ("a", "o"): 0.02, ("c", "e"): 0.03,
    ("f", "t"): 0.03, ("D", "O"): 0.03, ("Q", "O"): 0.03, ("C", "G"): 0.03, ("L", "1"): 0.03, ("T", "7"): 0.03, ("z", "2"): 0.03, ("q", "9"): 0.03, ("A", "4"): 0.02, ("l", "i"): 0.02, ("h", "li"): 0.02,
}
#: A place speaks for a confusion if it holds the other ideograph so many times, and so many times for each time it
#: holds this one; (places around it), (any places, where the other one is ``RARE`` times as frequent altogether).
STRICT, LOOSE, RARE = (8, 15), (4, 4), 10
#: Share of an ideograph's occurrences that must speak for a confusion, for each of these.
STRICT_SHARE, LOOSE_SHARE = 0.3, 0.5
#: Share of its occurrences, by any kind of place, in places that an ideograph itself holds most often: above it, it is no misreading.
OWN_SHARE = 0.1
#: Places that must speak strictly for a confusion of an ideograph whatever else it is used for.
PLACES = 4
#: A word may be a misread one if it is met at most so often, and so often for each time its candidate is met.
FREE, RATE = 2, 0.08
#: The rate for a word with a digit among its letters.
MIXED_RATE = 0.25
#: Rounds of estimating confusions, and the errors that the probabilities they start from count for.
ROUNDS, PRIOR = 2, 20.0
#: Prior odds that such a word is right, and the likelihood of a pair that was never met.
GENUINE, UNMET = 0.02, 1e-3
#: Power of a candidate's frequency in its likelihood.
WEIGHT = 0.3

#: Probability of (meant, seen).
Channel = dict[tuple[str, str], float]
_PART = re.compile(r"[A-Z0-9][A-Z0-9]+(?![a-z0-9])|[A-Z]?[a-z0-9À-ɏ̀-ͯЀ-ӿ]+|[A-Z0-9]+(?![a-z])|[A-Z]|[㐀-鿿]|[぀-ヿ]+|[。，、；：！？,.;:!?]")
_INNER = re.compile("[a-z]I")
HAN = r"^[\x{3400}-\x{9FFF}]$"
_HYPHEN = "[-\\x{2010}\\x{2011}\\x{AD}\\x{AC}]"
_PAGE = r"^(?:第\s*[0-9OoIl]+\s*[页頁]|[-—–]\s*[0-9OoIl]+\s*[-—–]|≦\s*[0-9OoIl]+\s*≧|[0-9]+\s*/\s*[0-9]+|\[\s*[0-9]+\s*\])$"
_PAGE_WORD = r"^(\w{4}|p\.)\s*([0-9OoIl]+)(?:\s*(\w\w|/)\s*[0-9OoIl]+)?$"
#: Least lines of a page, and by how much of the file's usual page a number further on may be off.
LINES, OFF = 8, 0.2


def _letters(column: Column) -> Column:
    return F.regexp_replace(F.lower(column), r"[^\p{L}]", "")


def furniture(lines: DataFrame) -> DataFrame:
    """``lines`` with ``t`` (trimmed text) and ``fault``: header, page_number or null.

    Windows over a file's lines share one sort for each order. A file is one scan; its lines are streamed, not collected.
    """
    ordered = W.partitionBy("file_name").orderBy("line_no", "line_id")
    above = ordered.rowsBetween(W.unboundedPreceding, -1)
    below = W.partitionBy("file_name").orderBy(F.desc("line_no"), F.desc("line_id")).rowsBetween(W.unboundedPreceding, -1)
    t = F.regexp_replace(F.coalesce("text", F.lit("")), r"(?U)^\s+|\s+$", "")
    base = lines.where("file_name is not null").select("line_id", "document_id", "src", "file_name", "line_no", "section", "text").withColumn("t", t)
    titled = base.withColumn("title", F.first(F.when(F.col("line_no") == 0, F.col("t")), ignorenulls=True).over(ordered.rowsBetween(W.unboundedPreceding, 0)))
    bare = F.regexp_replace("t", r"^[0-9]+\s{2,}|\s{2,}[0-9]+$|\s*\|.*$", "")
    key, own = _letters(F.col("title")), _letters(bare)
    close = (F.length(key) >= 4) & (F.levenshtein(own, key) <= F.greatest(F.lit(1), F.floor(F.length(key) / 8)))
    headed = titled.withColumn("head", (F.col("line_no") > 0) & F.coalesce(close, F.lit(False)))
    word, of = F.regexp_extract("t", _PAGE_WORD, 1), F.regexp_extract("t", _PAGE_WORD, 3)
    worded = F.col("t").rlike(_PAGE_WORD) & ((F.levenshtein(F.lower(word), F.lit("page")) <= 1) | (word == "p.")) & ((of == "") | (of == "/") | (F.levenshtein(F.lower(of), F.lit("of")) <= 1))
    marked = F.col("t").rlike(_PAGE)
    near = headed.withColumn("paged", marked | worded).withColumn("number", F.when(F.col("t").rlike(r"^[0-9]{1,5}$"), F.col("t").cast("int")))
    said = F.when(F.col("t") != "", F.struct("head", "line_no"))
    near = near.withColumn("before", F.last(said, ignorenulls=True).over(above)).withColumn("after", F.last(said, ignorenulls=True).over(below))
    beside = F.coalesce(F.col("before.head"), F.lit(False)) & (F.col("before.line_no") > 0) | F.coalesce(F.col("after.head"), F.lit(False))
    near = near.withColumn("beside", beside).withColumn("page", F.when(F.col("number").isNotNull() & beside & ~F.col("head"), F.col("number")))
    near = near.withColumn("anchor", F.when(F.col("page").isNotNull(), F.struct("page", "line_no")))
    near = near.withColumn("last", F.last("anchor", ignorenulls=True).over(above)).withColumn("following", F.last("anchor", ignorenulls=True).over(below))

    # lines of a page of this file, from its first and last known page
    file = W.partitionBy("file_name")
    ends = F.max(F.struct("anchor.line_no", "anchor.page")).over(file), F.min(F.when(F.col("anchor").isNotNull(), F.struct("anchor.line_no", "anchor.page"))).over(file)
    near = near.withColumn("latest", ends[0]).withColumn("first", ends[1])
    length = F.try_divide(F.col("latest.line_no") - F.col("first.line_no"), F.col("latest.page") - F.col("first.page"))

    def fits(pages: Column, distance: Column) -> Column:
        far = (pages > 1) & (length >= LINES) & (F.abs(distance - pages * length) <= OFF * length)
        return F.coalesce((pages == 1) & (distance >= LINES) | far, F.lit(False))

    goes_on = fits(F.col("number") - F.col("last.page"), F.col("line_no") - F.col("last.line_no")) | fits(F.col("following.page") - F.col("number"), F.col("following.line_no") - F.col("line_no"))
    counted = F.col("number").isNotNull() & (F.col("beside") | goes_on)
    fault = F.when(F.col("head"), "header").when((F.col("line_no") > 0) & (F.col("paged") | counted), "page_number")
    return near.select("line_id", "document_id", "src", "file_name", "line_no", "section", "t", fault.alias("fault"))


def joined(furnished: DataFrame) -> DataFrame:
    """Text lines with the next and previous text line of their file, and whether their last word goes on."""
    ordered = W.partitionBy("file_name").orderBy("line_no", "line_id")
    lead = F.regexp_replace("t", r"^(?://|\*|#)+\s*", "")
    texts = furnished.where("fault is null and t <> ''").withColumn("body", lead)
    texts = texts.withColumn("lead", F.length("t") - F.length("body")).withColumns({c: F.lead(v).over(ordered) for c, v in (("next", "body"), ("next_id", "line_id"), ("next_lead", "lead"))})
    goes_on = F.col("t").rlike(r"\p{L}[0-9]?" + _HYPHEN + "$") & F.col("next").rlike(r"^[\p{L}0-9]") & ~F.col("next").rlike(r"^[\p{IsHan}]")
    texts = texts.withColumn("hyphen", F.coalesce(goes_on, F.lit(False)))
    return texts.withColumn("begun", F.coalesce(F.lag("hyphen").over(ordered), F.lit(False)))


WORDS = "line_id long, next_id long, words array<string>, starts array<int>, cuts array<int>, skip int, merges array<struct<at int, seen string, meant string>>"


def words_of(texts: DataFrame) -> DataFrame:
    """(line_id, next_id, words, starts, cuts, skip, merges): the words of each line, a joined last word as a whole.

    ``starts`` are places in the line's ``t``. ``cuts`` holds for each word the number of its characters on this line, so that an
    error is put on its line; the rest follows at place ``skip`` of the next line. ``merges`` are runs of parts that read as
    one word if their inner capital I is an l.
    """
    small_batches(texts.sparkSession, 5000)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for t, body, nxt, hyphen, begun, skip in zip(b["t"], b["body"], b["next"], b["hyphen"], b["begun"], b["next_lead"]):
                base = len(t) - len(body)
                if begun:
                    base += re.match(r"[^\W_]*", body).end()
                text = t[base:]
                at = len(text)
                if hyphen:
                    at -= 1
                    text = text[:at] + re.match(r"[^\W_]*", nxt).group()
                found = [(m.group(), m.start()) for m in _PART.finditer(text)]
                words = [w for w, _ in found]
                out.append((words, [base + x for _, x in found], [min(len(w), max(0, at - x)) for w, x in found], 0 if pd.isna(skip) else int(skip), merges(found) if _INNER.search(text) else []))
            yield pd.DataFrame({"line_id": b["line_id"], "next_id": b["next_id"]} | {c: [o[i] for o in out] for i, c in enumerate(("words", "starts", "cuts", "skip", "merges"))})

    return texts.select("line_id", "next_id", "t", "body", "next", "hyphen", "begun", "next_lead").mapInPandas(run, WORDS)


def merges(found: list[tuple[str, int]]) -> list[dict]:
    """(at, seen, meant) of the parts, given with their places, that follow one another without a gap around a capital I."""
    out = []
    for i, (w, at) in enumerate(found[:-1]):
        if not w[-1].islower() or not w.isascii():
            continue
        seen, end = w, at + len(w)
        for v, place in found[i + 1 :]:
            if place != end or v[0] != "I" or not (v[1:].islower() or v.strip("I") == ""):
                break
            seen, end = seen + v, end + len(v)
        if seen != w:
            out.append({"at": i, "seen": seen, "meant": w + seen[len(w) :].replace("I", "l")})
    return out


def _pairs(words: DataFrame) -> DataFrame:
    both = F.expr("transform(sequence(0, size(words)), i -> concat(if(i = 0, '^', words[i - 1]), ' ', if(i = size(words), '$', words[i])))")
    return words.where("size(words) > 0").select(F.explode(both).alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))


def _places(words: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """(line_id, at, kind, place, x): the places of every ideograph, or of those in ``only`` (seen), a few.

    A place is the two words on each side (kind 0: one each; 1: two before; 2: two after), held as a hash: places are only counted.
    """
    at = "if(i + {0} < 0, '^', if(i + {0} >= size(words), '$', words[i + {0}]))"
    sides = ((-1, 1), (-2, -1), (1, 2))
    structs = ", ".join(f"struct(i AS at, {kind} AS kind, xxhash64({at.format(u)}, {at.format(v)}) AS place, words[i] AS x)" for kind, (u, v) in enumerate(sides))
    wanted = ", ".join(f"'{r['seen']}'" for r in only.select("seen").distinct().collect()) if only is not None else ""  # ideographs: bounded by their number
    wanted = wanted or "''"
    held = f"filter(sequence(0, size(words) - 1), i -> words[i] RLIKE '{HAN}')" if only is None else f"filter(sequence(0, size(words) - 1), i -> words[i] IN ({wanted}))"
    place = F.expr(f"filter(flatten(transform({held}, i -> array({structs}))), p -> NOT (p.kind = 1 AND p.at < 2 OR p.kind = 2 AND p.at > size(words) - 3))".replace("\\", "\\\\"))
    return words.where("size(words) > 1").select("line_id", F.inline(place))


def _tops(places: DataFrame) -> DataFrame:
    """Places by their most frequent ideograph, those that are met often enough to tell."""
    return places.groupBy("kind", "place").agg(F.max(F.struct("n", "x")).alias("top")).where(F.col("top.n") >= LOOSE[0])


def learned(places: DataFrame, counts: DataFrame) -> DataFrame:
    """(seen, meant, p, used) of ideographs: pairs where one stands in places that nearly always hold the other.

    Grouped by place, its most frequent ideograph is told from rare ones; only distinct ``places`` with their counts
    ``n`` meet, not lines. A pair is a confusion if enough of the seen one's occurrences, by one kind of place, speak
    for the same meant one. It also is one if ``PLACES`` places do so strictly, however often the seen one is
    ``used`` elsewhere: the odds of misreading are then those of the meant one's occurrences at such places against
    the seen one's others, and ``p`` gives them to the decoding, which weighs it against ``GENUINE`` and by frequency.
    """
    ideographs = counts.where(F.col("word").rlike(HAN))
    top = _tops(places)
    odd = places.join(top, ["kind", "place"]).where((F.col("x") != F.col("top.x")) & (F.col("n") * LOOSE[1] <= F.col("top.n")))
    strict = (F.col("kind") == 0) & (F.col("top.n") >= STRICT[0]) & (F.col("n") * STRICT[1] <= F.col("top.n"))
    evidence = odd.groupBy("kind", F.col("x").alias("seen"), F.col("top.x").alias("meant")).agg(F.sum(F.when(strict, F.col("n")).otherwise(0)).alias("e_strict"), F.sum("n").alias("e"), F.sum(strict.cast("int")).alias("places"))
    at_home = places.join(top, ["kind", "place"]).where(F.col("x") == F.col("top.x")).groupBy("kind", F.col("x").alias("seen")).agg(F.sum("n").alias("own")).groupBy("seen").agg(F.max("own").alias("own"))
    strongest = evidence.groupBy("seen", "meant").agg(F.max("e_strict").alias("e_strict"), F.max("e").alias("e"), F.max("places").alias("places"))
    held = top.where((F.col("kind") == 0) & (F.col("top.n") >= STRICT[0])).groupBy(F.col("top.x").alias("meant")).agg(F.sum("top.n").alias("n_held"))
    by_strict = (F.col("e_strict") >= STRICT_SHARE * F.col("n_seen")) & (F.col("n_meant") >= 2 * F.col("n_seen"))
    by_loose = (F.col("e") >= LOOSE_SHARE * F.col("n_seen")) & (F.col("n_meant") >= RARE * F.col("n_seen"))
    by_share = (by_strict | by_loose) & (F.coalesce("own", F.lit(0)) <= OWN_SHARE * F.col("n_seen"))
    misread = F.least(F.col("e_strict") / F.col("n_held") * F.col("n_meant"), 0.5 * F.col("n_seen"))
    odds = misread / (F.col("n_seen") - misread)
    return (
        strongest.join(ideographs.select(F.col("word").alias("seen"), F.col("n").alias("n_seen")), "seen")
        .join(ideographs.select(F.col("word").alias("meant"), F.col("n").alias("n_meant")), "meant")
        .join(at_home, "seen", "left")
        .join(held, "meant", "left")
        .where(by_share | (F.col("places") >= PLACES))
        .select("seen", "meant", F.when(by_share, F.least(F.lit(0.5), F.col("e") / F.col("n_seen"))).otherwise(GENUINE * odds / F.pow("n_meant", F.lit(WEIGHT))).alias("p"), (~by_share).alias("used"))
    )


def undone(word: str) -> dict[str, tuple[float, tuple[str, ...]]]:
    """Words that one or two confusions make into ``word``, with the probability of that and what was read for what."""
    out: dict[str, tuple[float, tuple[str, ...]]] = {}
    frontier: dict[str, tuple[float, tuple[str, ...]]] = {word: (1.0, ())}
    for _ in range(2):
        reached: dict[str, tuple[float, tuple[str, ...]]] = {}
        for w, (p, used) in frontier.items():
            for (meant, seen), q in CONFUSIONS.items():
                at = w.find(seen)
                while at >= 0:
                    v = w[:at] + meant + w[at + len(seen) :]
                    if v != word and p * q > max(reached.get(v, (0.0,))[0], out.get(v, (0.0,))[0]):
                        reached[v] = (p * q, (*used, f"{meant} {seen}"))
                    at = w.find(seen, at + 1)
        out |= reached
        frontier = reached
    return out


def _latin(counts: DataFrame) -> DataFrame:
    """(word, n_word, meant, used, n_meant): Latin words with the likelier words that misreading may have made them from.

    Longer words than the longest that is met often enough to be meant, and the two characters that two confusions add, need not be taken apart.
    """
    longest = counts.where(F.col("word").rlike("[A-Za-z]") & (F.col("n") >= 4)).agg(F.max(F.length("word"))).first()[0] or 0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(w, n, v, list(used)) for w, n in zip(b["word"], b["n"]) for v, (_, used) in undone(w).items()]
            yield pd.DataFrame(rows, columns=["word", "n_word", "meant", "used"])

    known = counts.select(F.col("word").alias("meant"), F.col("n").alias("n_meant"))
    rate = F.when(F.col("word").rlike("[A-Za-z][0-9][A-Za-z]|^[0-9][A-Za-z]{2}|[A-Za-z]{3}[015]$"), MIXED_RATE).otherwise(RATE)
    asked = counts.where(F.col("word").rlike("[A-Za-z]") & F.length("word").between(2, longest + 2)).mapInPandas(run, "word string, n_word long, meant string, used array<string>")
    return asked.join(known, "meant").where((F.col("n_word") <= FREE + rate * F.col("n_meant")) & (F.col("n_meant") >= 4 * F.col("n_word")))


def _likelihood(channel: Channel) -> Column:
    """The probability of the confusions in ``used``."""
    p = F.create_map(*[F.lit(x) for (meant, seen), q in channel.items() for x in (f"{meant} {seen}", float(q))])
    return F.aggregate("used", F.lit(1.0), lambda acc, u: acc * F.element_at(p, u))


def estimated(doubtful: DataFrame, rounds: int = ROUNDS, prior: float = PRIOR) -> Channel:
    """Confusion probabilities of the corpus by expectation maximization, from those of ``CONFUSIONS``.

    Expectation: each doubtful word is one of its candidates, or right, in proportion to probability and frequency, and its
    occurrences count for the confusions that made it. Maximization: of all errors at a character, the share of each confusion, with
    the starting probabilities counting for ``prior`` errors. One number per confusion reaches the driver.
    """
    channel = dict(CONFUSIONS)
    for _ in range(rounds):
        w = _likelihood(channel) * F.pow("n_meant", F.lit(WEIGHT))
        share = F.col("w") / (F.sum("w").over(W.partitionBy("word")) + GENUINE) * F.col("n_word")
        errors = {r["used"]: r["e"] for r in doubtful.withColumn("w", w).withColumn("share", share).select(F.explode("used").alias("used"), "share").groupBy("used").agg(F.sum("share").alias("e")).collect()}
        at: dict[str, float] = {}
        for meant, seen in channel:
            at[meant] = at.get(meant, 0.0) + errors.get(f"{meant} {seen}", 0.0)
        channel = {(m, x): (errors.get(f"{m} {x}", 0.0) + prior * q) / (at[m] + prior) for (m, x), q in CONFUSIONS.items()}
    return channel


def candidates(counts: DataFrame, confusions: DataFrame) -> DataFrame:
    """(word, options): for each distinct word the likelier words that misreading may have made it from.

    A word is kept as it is where it is met more often than misreading its candidate explains.
    """
    doubtful = materialize(_latin(counts))
    latin = doubtful.withColumn("p", _likelihood(estimated(doubtful)))
    known = counts.select(F.col("word").alias("meant"), F.col("n").alias("n_meant"))
    han = confusions.join(counts, confusions["seen"] == counts["word"]).select("word", F.col("n").alias("n_word"), "meant", "p").join(known, "meant")
    columns = ("word", "n_word", "meant", "p", "n_meant")
    return latin.select(*columns).unionByName(han.select(*columns)).groupBy("word").agg(F.max("n_word").alias("n_word"), F.collect_list(F.struct("meant", "p", "n_meant")).alias("options"))


def viterbi(words: list[str], options: dict[int, list[tuple[str, float, int]]], own: dict[int, int], pairs: dict[str, int]) -> dict[int, str]:
    """Position to word of every word that reads better as another one."""
    changed: dict[int, str] = {}
    positions = sorted(options)
    at = 0
    while at < len(positions):
        run = [positions[at]]
        while at + 1 < len(positions) and positions[at + 1] == run[-1] + 1:
            at += 1
            run.append(positions[at])
        at += 1
        before = words[run[0] - 1] if run[0] else "^"
        states: list[tuple[float, list[str], str]] = [(0.0, [], before)]
        for i in run:
            here = [(words[i], math.log(GENUINE), own.get(i, 1)), *((m, math.log(p) + WEIGHT * math.log(n), n) for m, p, n in options[i])]
            held = here
            states = [
                max(((s + emit + _link(pairs, f"{prev} {{}}", w, n, options[i] if w == words[i] else None), [*path, w], w) for s, path, prev in states), key=lambda x: x[0])
                for w, emit, n in here
            ]
        after = words[run[-1] + 1] if run[-1] + 1 < len(words) else "$"
        times = {w: n for w, _, n in held}
        best = max(states, key=lambda s: s[0] + _link(pairs, f"{{}} {after}", s[2], times[s[2]], options[run[-1]] if s[2] == words[run[-1]] else None))
        changed |= {i: w for i, w in zip(run, best[1]) if w != words[i]}
    return changed


def _link(pairs: dict[str, int], place: str, w: str, n: int, rivals: list[tuple[str, float, int]] | None) -> float:
    """Log of the share of a word's ``n`` occurrences that stand in this pair.

    A word as read, which has ``rivals``, does not count itself. An ideograph does not count those either that
    misreading a rival explains, since the same confusion is made again wherever the rival stands.
    """
    met = pairs.get(place.format(w), 0) - (rivals is not None)
    if rivals and len(w) == 1 and any(met < FREE + RATE * k and k >= 4 * met for k in (pairs.get(place.format(m), 0) for m, _, _ in rivals)):
        met = 0
    return math.log(max(0, met) / max(1, n) + UNMET)


def _differs(word: str, meant: str, cut: int) -> tuple[bool, bool]:
    """Whether the characters before and from ``cut`` of a word differ from what is meant."""
    same = next((i for i, (x, y) in enumerate(zip(word, meant)) if x != y), min(len(word), len(meant)))
    tail = next((i for i, (x, y) in enumerate(zip(word[same:][::-1], meant[same:][::-1])) if x != y), min(len(word), len(meant)) - same)
    end = len(word) - tail
    return same < cut, end > cut or same >= cut


def _merged(words: DataFrame, counts: DataFrame) -> DataFrame:
    """(line_id, next_id, start, cut, skip, word, meant) of the runs of parts that are one word with l for its inner I."""
    rows = words.where("size(merges) > 0").select("line_id", "next_id", "words", "starts", "cuts", "skip", F.explode("merges").alias("m")).select("*", "m.seen", "m.meant")
    seen = rows.groupBy("seen", "meant").agg(F.count("*").alias("n"))
    known = counts.select(F.col("word").alias("meant"), F.col("n").alias("n_meant"))
    sure = seen.join(known, "meant").where((F.col("n") <= FREE + RATE * F.col("n_meant")) & (F.col("n_meant") >= 4 * F.col("n"))).select("seen", "meant")
    ends = F.expr("starts[m.at] + length(seen)")
    last = F.expr("filter(sequence(m.at, size(words) - 1), i -> starts[i] + cuts[i] < starts[i] + length(words[i]))")
    here = F.when(F.size(last) > 0, F.get("starts", F.get(last, F.lit(0))) + F.get("cuts", F.get(last, F.lit(0)))).otherwise(ends)
    return rows.join(sure, ["seen", "meant"]).select("line_id", "next_id", F.expr("starts[m.at]").alias("start"), F.greatest(F.lit(0), F.least(here, ends) - F.expr("starts[m.at]")).alias("cut"), "skip", F.col("seen").alias("word"), "meant")


def decoded(words: DataFrame) -> DataFrame:
    """(line_id, next_id, start, cut, skip, word, meant) of every misread word, by its place and how much of it is on the line.

    An ideograph that is used rightly elsewhere is left as it is in places that it holds too often for a misread one.
    """
    words = materialize(words)
    counts = materialize(words.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n")))
    places = materialize(_places(words).groupBy("kind", "place", "x").agg(F.count("*").alias("n")))
    confusions = materialize(learned(places, counts))
    options = materialize(candidates(counts, confusions))
    used = confusions.where("used").select("seen").distinct()
    own = places.join(_tops(places), ["kind", "place"]).where((F.col("n") >= LOOSE[0]) & (F.col("n") * LOOSE[1] > F.col("top.n"))).select("kind", "place", "x")
    at_home = _places(words, used).join(own, ["kind", "place", "x"], "left_semi").select("line_id", "at").distinct()
    spread = words.select("line_id", F.posexplode("words").alias("at", "word")).join(at_home, ["line_id", "at"], "left_anti")
    open_ = spread.join(options, "word").groupBy("line_id").agg(F.collect_list(F.struct("at", "n_word", "options")).alias("open"))
    lattices = materialize(words.join(open_, "line_id"))

    needed = F.expr(
        """array_distinct(flatten(transform(open, o -> flatten(transform(concat(array(words[o.at]), o.options.meant), w -> concat(
            transform(array_distinct(concat(array(if(o.at = 0, '^', words[o.at - 1])), flatten(transform(filter(open, q -> q.at = o.at - 1), q -> q.options.meant)))), l -> concat(l, ' ', w)),
            transform(array_distinct(concat(array(if(o.at = size(words) - 1, '$', words[o.at + 1])), flatten(transform(filter(open, q -> q.at = o.at + 1), q -> q.options.meant)))), r -> concat(w, ' ', r))))))))"""
    )
    asked = lattices.select("line_id", F.explode(needed).alias("pair"))
    met = left_join_unique(asked, _pairs(words), "pair", hot_keys(asked, "pair")).where("n is not null").groupBy("line_id").agg(F.map_from_entries(F.collect_list(F.struct("pair", "n"))).alias("pairs"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for line_id, next_id, ws, starts, cuts, skip, opened, pairs in zip(b["line_id"], b["next_id"], b["words"], b["starts"], b["cuts"], b["skip"], b["open"], b["pairs"]):
                ws = list(ws)
                held = {int(o["at"]): [(x["meant"], x["p"], x["n_meant"]) for x in o["options"]] for o in opened}
                own = {int(o["at"]): int(o["n_word"]) for o in opened}
                for i, meant in viterbi(ws, held, own, dict(pairs) if pairs is not None else {}).items():
                    rows.append((line_id, None if pd.isna(next_id) else int(next_id), int(starts[i]), int(cuts[i]), int(skip), ws[i], meant))
            yield pd.DataFrame({c: [x[i] for x in rows] for i, c in enumerate(FIXES)}).astype({"next_id": "Int64"})

    read = lattices.join(met, "line_id", "left").mapInPandas(run, "line_id long, next_id long, start int, cut int, skip int, word string, meant string")
    return read.unionByName(_merged(words, counts))


FIXES = ("line_id", "next_id", "start", "cut", "skip", "word", "meant")


def misread_lines(fixes: DataFrame) -> DataFrame:
    """line_id of every line that holds a wrong character."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids = []
            for line_id, next_id, cut, word, meant in zip(b["line_id"], b["next_id"], b["cut"], b["word"], b["meant"]):
                here, there = _differs(word, meant, cut)
                ids += [line_id] * here + ([int(next_id)] if there and not pd.isna(next_id) else [])
            yield pd.DataFrame({"line_id": pd.Series(ids, dtype="int64")})

    return fixes.mapInPandas(run, "line_id long")


def found(lines: DataFrame) -> DataFrame:
    """(line_id, fault), distinct."""
    held = materialize(furniture(lines))
    texts = materialize(joined(held))
    furnished = held.where("fault is not null").select("line_id", "fault")
    hyphens = texts.where("hyphen").select("line_id", F.lit("hyphen").alias("fault"))
    misread = misread_lines(decoded(words_of(texts))).select("line_id", F.lit("misread").alias("fault"))
    return furnished.unionByName(hyphens).unionByName(misread).distinct()


def _kept_hyphens(texts: DataFrame) -> DataFrame:
    """line_id of the lines whose last hyphen belongs to the word: the corpus has the compound more often than the joined word.

    Both forms are counted where they stand within a line.
    """
    ends = texts.where("hyphen").select("line_id", F.regexp_extract("t", r"([\p{L}\p{N}]+)-$", 1).alias("a"), F.regexp_extract("next", r"^([\p{L}\p{N}]+)", 1).alias("b")).where("a <> ''")
    forms = ends.select("line_id", F.explode(F.array(F.struct(F.concat("a", F.lit("-"), "b").alias("form"), F.lit(1).alias("sign")), F.struct(F.concat("a", "b").alias("form"), F.lit(-1).alias("sign")))).alias("f")).select("line_id", "f.form", "f.sign")
    inner = F.concat(F.regexp_extract_all("t", F.lit(r"[\p{L}\p{N}]+-[\p{L}\p{N}]+"), 0), F.regexp_extract_all("t", F.lit(r"[\p{L}\p{N}]+"), 0))
    met = texts.select(F.explode(inner).alias("form")).join(forms.select("form").distinct(), "form", "left_semi").groupBy("form").agg(F.count("*").alias("n"))
    return forms.join(met, "form").groupBy("line_id").agg(F.sum(F.col("n") * F.col("sign")).alias("more")).where("more > 0").select("line_id")


def paragraphs(lines: DataFrame) -> DataFrame:
    """(file_name, section, paragraph_no, text): repaired text, one row per paragraph.

    A blank line, a change of section or the end of the file ends a paragraph. Misread words are replaced at their own places and
    nowhere else, halves of words are joined (with the hyphen, if that belongs to the word), comment marks before the second half go, and
    Latin lines are joined by a blank.
    """
    held = materialize(furniture(lines))
    texts = materialize(joined(held))
    fixes = materialize(decoded(words_of(texts)))
    edit = lambda start, n, by: F.struct(start.cast("int").alias("start"), n.cast("int").alias("n"), by.alias("by"))
    here = fixes.select("line_id", edit(F.col("start"), F.col("cut"), F.col("meant")).alias("e"))
    rest = fixes.where(F.col("cut") < F.length("word")).select(F.col("next_id").alias("line_id"), edit(F.col("skip"), F.length("word") - F.col("cut"), F.lit("")).alias("e"))
    leads = texts.where("begun and lead > 0").select("line_id", edit(F.lit(0), F.col("lead"), F.lit("")).alias("e"))
    edits = here.unionByName(rest).unionByName(leads).groupBy("line_id").agg(F.reverse(F.array_sort(F.collect_set("e"))).alias("edits"))
    ordered = W.partitionBy("file_name").orderBy("line_no", "line_id")
    kept = held.where("fault is null").withColumn("section", F.coalesce("section", F.last("section", ignorenulls=True).over(ordered)))
    edge = (F.col("t") == "") | ~F.coalesce(F.col("section").eqNullSafe(F.lag("section").over(ordered)), F.lit(False))
    kept = kept.withColumn("paragraph_no", F.sum(edge.cast("int")).over(ordered)).where("t <> ''").join(texts.select("line_id", "hyphen"), "line_id", "left").join(edits, "line_id", "left")
    kept = kept.join(_kept_hyphens(texts).withColumn("compound", F.lit(True)), "line_id", "left")
    done = F.aggregate(F.coalesce("edits", F.array().cast("array<struct<start:int,n:int,by:string>>")), F.col("t"), lambda acc, e: F.concat(F.substring(acc, F.lit(1), e["start"]), e["by"], F.substring(acc, e["start"] + e["n"] + 1, F.length(acc))))
    t = F.col("done")
    ended = F.when(F.col("hyphen") & F.col("compound").isNull(), F.regexp_replace(t, _HYPHEN + "$", "")).when(F.col("hyphen") | t.rlike(r"[\p{IsHan}，。、；：！？）》]$"), t).otherwise(F.concat(t, F.lit(" ")))
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line_id", "piece"))), lambda x: x["piece"])
    return kept.withColumn("done", done).withColumn("piece", ended).groupBy("file_name", "section", "paragraph_no").agg(F.trim(F.array_join(pieces, "")).alias("text"))
