"""Texts that were cut off, found by how word trigrams end texts, in pure SQL.

Every word of every text is counted with the two words before it, with one, and alone: how often inside texts and
how often at their end, and for each beginning of a word how often a longer word stands there inside. The words at
the end of an unfinished text are then joined with these counts. A trigram that is frequent inside texts but almost
never ends one was cut; where a trigram is too rare to tell, the bigram and then the word alone decides.

Words are evened out first: identifiers and numbers become one word each, so that a phrase that may end a text is
recognised whatever name it holds. A word of a text that ends in one of the corpus's own identifiers cut short is
looked up as an identifier too. Counts cover all texts, each once however many rows hold it, with or without a mark
left by the cut, since copies of one cut prove nothing about it; the join is salted, so that an ending held by a third of
all rows is spread out.

Defined results. Null, empty and blank texts are no cases, nor is a text that ends in a sentence mark. A mark left
by the cut ("...", an ellipsis, a broken character) is looked through.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.charfold import _tables
from graphloom.session import materialize

#: Occurrences from which a trigram, or else a bigram, is trusted.
EVIDENCE = 5
#: Times that an ending must be met inside texts for each time it ends another text: trigrams, shorter ones.
RATIO, SHORT_RATIO = 3, 25
SALTS = 16

_LETTER = r"A-Za-z\\x{C0}-\\x{24F}\\x{300}-\\x{52F}"
_CJK = r"\\x{3040}-\\x{30FF}\\x{3400}-\\x{4DBF}\\x{4E00}-\\x{9FFF}"
#: Steps of the statements, each a common table expression over ``texts`` (rec_id, field_name, feed, asked, text). The
#: last step of a statement is held as a table, so that what several later steps read is computed once.
_STATEMENTS = {
  "worded": {
    "plain": "SELECT rec_id, field_name, feed, asked, trim(translate(text, '{source}', '{target}')) AS t FROM texts WHERE text IS NOT NULL",
    "bare": r"""SELECT rec_id, field_name, feed, asked, t RLIKE '[.。!?！？]$' AND NOT t RLIKE '(\\.\\.|…|\\x{{FFFD}})$' AS whole,
        regexp_replace(t, '(\\s|…|\\.{{2,}}|\\x{{FFFD}})+$', '') AS t FROM plain WHERE t <> ''""",
    "evened": r"""SELECT rec_id, field_name, feed, asked, whole, xxhash64(t) AS text_hash,
        regexp_replace(regexp_replace(t, '[A-Za-z0-9]*[A-Za-z][A-Za-z0-9]*_\\w*|[A-Za-z]*[a-z][A-Z]\\w*', '<N>'), '0x[0-9A-Fa-f]*|[0-9]+', '<#>') AS t FROM bare WHERE t <> ''""",
    "worded": """SELECT rec_id, field_name, feed, asked, whole, text_hash,
        concat(array('^', '^'), regexp_extract_all(t, '<N>|<#>|[{letter}]+(?:[-''][{letter}]+)*|[{cjk}]|[^\\\\s\\\\w]', 0)) AS w FROM evened""",
  }, "counts": {
    "held": "SELECT any_value(w) AS w FROM worded WHERE size(w) > 2 GROUP BY text_hash",
    "grams": """SELECT inline(flatten(transform(sequence(2, size(w) - 1), i -> array(
            named_struct('lv', 1, 'ctx', '', 'word', w[i], 'fin', i = size(w) - 1),
            named_struct('lv', 2, 'ctx', w[i - 1], 'word', w[i], 'fin', i = size(w) - 1),
            named_struct('lv', 3, 'ctx', concat(w[i - 2], ' ', w[i - 1]), 'word', w[i], 'fin', i = size(w) - 1))))) FROM held""",
    "counts": "SELECT lv, ctx, word, count_if(NOT fin) AS n_in, count_if(fin) AS n_end FROM grams GROUP BY lv, ctx, word",
  }, "verdicts": {
    "begun": """SELECT lv, ctx, explode(transform(sequence(1, length(word) - 1), n -> left(word, n))) AS word, n_in AS n_pre
        FROM counts WHERE n_in > 0 AND length(word) > 1 AND word NOT LIKE '<%'""",
    "stats": """SELECT lv, ctx, word, sum(n_in) AS n_in, sum(n_end) AS n_end, sum(n_pre) AS n_pre FROM (
        SELECT lv, ctx, word, n_in, n_end, 0L AS n_pre FROM counts UNION ALL SELECT lv, ctx, word, 0L, 0L, n_pre FROM begun) GROUP BY lv, ctx, word""",
    "finals": """SELECT rec_id, field_name, w, inline(flatten(transform(
            CASE WHEN element_at(w, -1) RLIKE '^([A-Z]|[a-z]{{1,3}}$)' THEN array(element_at(w, -1), '<N>') ELSE array(element_at(w, -1)) END,
            x -> array(named_struct('lv', 1, 'ctx', '', 'word', x), named_struct('lv', 2, 'ctx', w[size(w) - 2], 'word', x),
                named_struct('lv', 3, 'ctx', concat(w[size(w) - 3], ' ', w[size(w) - 2]), 'word', x)))))
        FROM worded WHERE asked AND NOT whole AND size(w) > 2""",
    "endings": "SELECT DISTINCT lv, ctx, word FROM finals",
    "known": "SELECT s.*, salt FROM stats s LEFT SEMI JOIN endings e ON s.lv = e.lv AND s.ctx = e.ctx AND s.word = e.word LATERAL VIEW explode(sequence(0, {salts} - 1)) x AS salt",
    "met": """SELECT f.rec_id, f.field_name, element_at(f.w, -1) AS last, f.word, f.lv, coalesce(n_in, 0) AS n_in, coalesce(n_pre, 0) AS n_pre, greatest(coalesce(n_end, 1) - 1, 0) AS others
        FROM (SELECT *, pmod(xxhash64(rec_id), {salts}) AS salt FROM finals) f LEFT JOIN known s ON f.lv = s.lv AND f.ctx = s.ctx AND f.word = s.word AND f.salt = s.salt""",
    "seen": """SELECT rec_id, field_name, last, word, max(CASE WHEN lv = 1 THEN n_in END) AS alone,
            max(struct(CASE WHEN lv = 1 OR n_in + n_pre + others >= {evidence} THEN lv ELSE 0 END AS lv, n_in + n_pre AS inner_n, others)) AS best
        FROM met GROUP BY rec_id, field_name, last, word""",
    "verdicts": """SELECT rec_id, field_name, max(CASE WHEN word = last OR last_alone = 0 THEN best.inner_n > best.others * CASE WHEN best.lv = 3 THEN {ratio} ELSE {short_ratio} END ELSE false END) AS cut
        FROM (SELECT *, max(CASE WHEN word = last THEN alone END) OVER (PARTITION BY rec_id, field_name) AS last_alone FROM seen) GROUP BY rec_id, field_name""",
  },
}


def statement(last: str, select: str) -> str:
    """The SQL statement whose steps end with ``last``, followed by ``select``."""
    source, target, _ = _tables()
    quote = lambda s: s.replace("\\", "\\\\").replace("'", "\\'")
    values = dict(source=quote(source), target=quote(target), letter=_LETTER, cjk=_CJK, salts=SALTS, evidence=EVIDENCE, ratio=RATIO, short_ratio=SHORT_RATIO)
    return "WITH " + ",\n".join(f"{name} AS ({sql.format(**values)})" for name, sql in _STATEMENTS[last].items()) + "\n" + select


def texts(entities: DataFrame) -> DataFrame:
    """All descriptions and remarks; ``asked`` marks those whose truncation is asked for."""
    both = F.array(
        F.struct(F.lit("description").alias("f"), F.col("description").alias("v"), F.coalesce(F.col("src") == "t", F.lit(False)).alias("a")),
        F.struct(F.lit("remarks").alias("f"), F.col("remarks").alias("v"), F.coalesce(F.col("src") == "p", F.lit(False)).alias("a")),
    )
    return entities.select("rec_id", "feed", F.explode(both).alias("x")).select("rec_id", F.col("x.f").alias("field_name"), "feed", F.col("x.a").alias("asked"), F.col("x.v").alias("text"))


def found(entities: DataFrame) -> DataFrame:
    """(rec_id, field_name) of the texts that were cut off."""
    return _run(entities, "SELECT DISTINCT rec_id, field_name FROM verdicts WHERE cut")


def _run(entities: DataFrame, select: str) -> DataFrame:
    """The result of ``select`` over texts and verdicts; views have names of their own and are gone when this returns."""
    spark, mark = entities.sparkSession, uuid.uuid4().hex
    views: dict[str, str] = {}

    def view(name: str, df: DataFrame) -> None:
        views[name] = f"{name}_{mark}"
        df.createOrReplaceTempView(views[name])

    def run(last: str, chosen: str) -> DataFrame:
        own = statement(last, chosen)
        return spark.sql(re.sub(rf"\bFROM ({'|'.join(views)})\b", lambda m: f"FROM {views[m.group(1)]}", own))

    view("texts", texts(entities))
    worded = materialize(run("worded", "SELECT * FROM worded"))
    view("worded", worded)
    counts = materialize(run("counts", "SELECT * FROM counts"))
    view("counts", counts)
    out = run("verdicts", select)
    for name in views.values():
        spark.catalog.dropTempView(name)
    return out


def report(entities: DataFrame) -> DataFrame:
    """Per feed and field: rows with a text, rows cut, and their share."""
    return _run(
        entities,
        """SELECT feed, p.field_name, count(*) AS n_texts, count_if(coalesce(cut, false)) AS n_cut, round(count_if(coalesce(cut, false)) / count(*), 6) AS share
        FROM (SELECT * FROM texts WHERE asked AND trim(text) <> '') p LEFT JOIN verdicts v ON p.rec_id = v.rec_id AND p.field_name = v.field_name GROUP BY feed, p.field_name""",
    )
