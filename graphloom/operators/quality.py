"""Scores of document variants, the choice between them, and checks of what was extracted."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.functions import text as T
from graphloom.grammar import EXTRACTED_TYPES, OCR, Grammar
from graphloom.operators.lines import DOC

#: Weights of the fields a variant covers, and score differences from which the better one is taken.
FIELD_WEIGHTS = {"syntax": 2.0, "parameters": 1.5, "members": 1.5, "return_value": 1.0, "remarks": 1.0, "requirements": 1.0, "header": 0.5}
DECIDED = 0.005
SAMPLES = 5


def _there(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    c = F.col(name)
    return F.coalesce(F.size(c) > 0, F.lit(False)) if kind.startswith("array") else F.coalesce(c != "", F.lit(False)) if kind == "string" else c.isNotNull()


def scores(entities: DataFrame, g: Grammar = OCR) -> DataFrame:
    """One row per variant: counts, ratios and the score; one aggregation."""
    n = F.count("*")
    desc = F.coalesce("description", F.lit(""))
    any_of = lambda tokens: F.lit(False) if not tokens else desc.rlike("|".join(tokens))
    share = lambda c: F.sum(c.cast("int")) / n
    covered = sum((F.when(_there(entities, f), F.lit(w)).otherwise(0.0) for f, w in FIELD_WEIGHTS.items()), F.lit(0.0))
    rows = entities.groupBy(*DOC).agg(
        n.cast("int").alias("total"), F.avg(F.coalesce("confidence", F.lit(0.0))).alias("avg_conf"), share(F.coalesce("entity_type", F.lit("unknown")) != "unknown").alias("typed_ratio"),
        (F.sum(covered) / (n * F.lit(sum(FIELD_WEIGHTS.values())))).alias("field_coverage"), F.avg(F.length(desc)).alias("avg_desc_len"),
        (F.sum(any_of(g.noise_tokens).cast("int") + any_of(("ﾉ", "展开表")).cast("int")) / (n * 2)).alias("noise_ratio"), share(_there(entities, "syntax")).alias("syntax_ratio"),
    )
    score = (
        0.10 * F.least(F.col("total") / 20, F.lit(1.0)) + 0.20 * F.col("avg_conf") + 0.15 * F.col("typed_ratio") + 0.20 * F.col("field_coverage")
        + 0.15 * F.least(F.col("avg_desc_len") / 100, F.lit(1.0)) + 0.10 * F.col("syntax_ratio") - 0.10 * F.col("noise_ratio")
    )
    r4 = {c: F.bround(c, 4) for c in ("avg_conf", "typed_ratio", "field_coverage", "noise_ratio", "syntax_ratio")}
    return rows.withColumn("score", F.bround(score, 6)).withColumns(r4 | {"avg_desc_len": F.bround("avg_desc_len", 1)})


def decide(variants: DataFrame, scored: DataFrame) -> DataFrame:
    """(doc_id, decision, winner, p_score, t_score): the variant taken for each document, and why.

    Equal scores take p. A difference below ``DECIDED`` is left to a judge, with p as long as none decides.
    """
    score = scored.select(*DOC, "score")
    side = lambda s: variants.where(F.col("src") == s).join(score, [*DOC], "left").select("doc_id", F.coalesce("score", F.lit(0.0)).alias(f"{s}_score"))
    both = side("p").join(side("t"), "doc_id", "full_outer")
    p, t = F.col("p_score"), F.col("t_score")
    shown = F.concat(F.lit("(p="), T.fixed(p, 3), F.lit(" t="), T.fixed(t, 3), F.lit(")"))
    decision = (
        F.when(p.isNull() & t.isNull(), "none").when(t.isNull(), "only_p").when(p.isNull(), "only_t")
        .when(p == t, F.concat(F.lit("identical (score="), T.fixed(p, 4), F.lit(")")))
        .when(p - t >= DECIDED, F.concat(F.lit("heuristic_p "), shown)).when(t - p >= DECIDED, F.concat(F.lit("heuristic_t "), shown))
        .otherwise("llm_pending")
    )
    winner = F.when(p.isNull(), F.when(t.isNotNull(), "t")).when(t.isNotNull() & (t - p >= DECIDED), "t").otherwise("p")
    return both.select("doc_id", decision.alias("decision"), winner.alias("winner"), "p_score", "t_score")


def adjudicate(decisions: DataFrame, entities: DataFrame, judge: Callable[[list[dict], list[dict]], str | None]) -> DataFrame:
    """``decisions`` with pending ones put to ``judge`` by the first entities of each side; "B" takes t, all else p."""
    first = F.row_number().over(W.partitionBy(*DOC).orderBy("ord"))  # cut before rows are gathered: a document may hold many
    sample = (
        entities.join(decisions.where("decision = 'llm_pending'").select("doc_id"), "doc_id", "left_semi")
        .select(*DOC, "ord", "name", "entity_type", "description", "confidence").withColumn("nth", first).where(F.col("nth") <= SAMPLES)
        .groupBy(*DOC).agg(F.array_sort(F.collect_list(F.struct("ord", "name", "entity_type", "description", "confidence"))).alias("sample"))
        .groupBy("doc_id").agg(F.max(F.when(F.col("src") == "p", F.col("sample"))).alias("a"), F.max(F.when(F.col("src") == "t", F.col("sample"))).alias("b"))
    )

    def run(batches):
        for b in batches:
            plain = lambda xs: [x.asDict() if hasattr(x, "asDict") else dict(x) for x in (xs if xs is not None else [])]
            b["verdict"] = [judge(plain(x), plain(y)) for x, y in zip(b["a"], b["b"])]
            yield b[["doc_id", "verdict"]]

    verdicts = sample.mapInPandas(run, "doc_id string, verdict string")
    pending = F.col("decision") == "llm_pending"
    won = F.when(pending & (F.col("verdict") == "B"), "t").otherwise(F.col("winner"))
    named = F.when(pending & F.col("verdict").isin("A", "B"), F.concat(F.lit("llm_"), F.when(F.col("verdict") == "B", "t").otherwise("p"))).otherwise(F.col("decision"))
    return decisions.join(verdicts, "doc_id", "left").select("doc_id", named.alias("decision"), won.alias("winner"), "p_score", "t_score")


def selected(entities: DataFrame, decisions: DataFrame) -> DataFrame:
    """Entities of the variant taken for each document."""
    won = decisions.where("winner is not null").select("doc_id", F.col("winner").alias("src"))
    return entities.join(won, [*DOC], "left_semi")


def self_test(entities: DataFrame, g: Grammar = OCR) -> DataFrame:
    """Per variant the number of violations of each invariant; one aggregation."""
    ids = entities.groupBy(*DOC, "id").agg(F.count("*").alias("n"))
    repeated = ids.groupBy(*DOC).agg(F.sum(F.col("n") - 1).alias("duplicate_ids"))
    missing = sum((F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", 1).otherwise(0) for c in ("id", "name", "entity_type", "description", "confidence")), F.lit(0))
    noisy = F.coalesce(F.col("description").rlike("|".join(g.noise_tokens)), F.lit(False))
    bad = entities.groupBy(*DOC).agg(
        F.sum(missing).alias("missing_fields"), F.sum(noisy.cast("int")).alias("noisy_texts"), F.sum((~F.col("entity_type").isin(*EXTRACTED_TYPES)).cast("int")).alias("invalid_types"),
        F.sum((~F.col("confidence").between(0, 1)).cast("int")).alias("bad_confidence"), (F.avg((F.col("entity_type") == "unknown").cast("int")) > 0.3).alias("mostly_unknown"),
    )
    return bad.join(repeated, [*DOC])


def totals(decisions: DataFrame, entities: DataFrame, edges: DataFrame) -> DataFrame:
    """One row of run totals."""
    count = lambda df, name, what=F.lit(1): df.select(F.lit(name).alias("k"), what.cast("long").alias("v"))
    judged = F.col("decision").startswith("llm").cast("int")
    rows = count(decisions, "total_pairs").unionByName(count(decisions, "llm_compares", judged)).unionByName(count(entities, "total_entities")).unionByName(count(edges, "total_edges"))
    names = ["total_pairs", "llm_compares", "total_entities", "total_edges"]
    return rows.agg(*[F.coalesce(F.sum(F.when(F.col("k") == n, F.col("v"))), F.lit(0)).alias(n) for n in names])


def last_wins(rows: DataFrame, key: str, order: Column) -> DataFrame:
    """One row per key, the last by ``order``; combined on the map side."""
    columns = F.struct(*[F.col(c) for c in rows.columns if c != key])
    return rows.groupBy(key).agg(F.max_by(columns, order).alias("x")).select(key, "x.*")


def global_index(entities: DataFrame, order: str = "source_file") -> DataFrame:
    """(name, id, file, type) of each name, the last document winning."""
    rows = entities.select("name", "id", F.col("source_file").alias("file"), F.col("entity_type").alias("type"))
    return last_wins(rows, "name", F.col("file"))


def changed_files(scans: DataFrame, known: DataFrame) -> DataFrame:
    """Scans whose bytes are not yet known by (file_name, md5)."""
    return scans.join(known.select("file_name", "md5"), ["file_name", "md5"], "left_anti")
