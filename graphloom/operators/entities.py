"""Entities from segments: fields, merging of repeated names, cross references, confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.functions import text as T
from graphloom.grammar import OCR, Grammar
from graphloom.operators import fields
from graphloom.operators.lines import DOC

_NULLABLE = ("syntax", "remarks")


def parsed(segments: DataFrame, g: Grammar = OCR) -> DataFrame:
    """One row per segment with its fields parsed; descriptions are cut where an earlier entity's name comes late."""
    name = F.col("name")
    without = lambda p: F.when(p.startswith(name), T.strip(F.substring(p, F.length(name) + F.lit(1), F.lit(1_000_000)))).otherwise(p)
    prose = F.filter(F.transform(F.col("description"), T.strip), lambda p: (p != "") & ~T.is_meta(p) & ~p.rlike(T.ARTICLE_META))
    prose = F.filter(F.transform(prose, without), lambda p: p != "")
    syntax = F.filter(F.col("syntax"), lambda s: ~T.is_noise(s, g))
    see_also = F.filter(F.col("see_also"), lambda s: ~T.is_noise(s, g))
    order = F.col("seg") * 2 + F.col("sub")
    base = segments.select(
        *DOC, order.alias("ord"), "name", (F.col("start_line") + 1).alias("source_line"), F.nullif(F.col("header"), F.lit("")).alias("header"),
        T.infer_type(name, F.col("section"), g).alias("entity_type"), T.clean_text(F.array_join(prose, " "), g).alias("description"),
        F.nullif(T.strip(F.regexp_replace(F.array_join(syntax, "\n"), "ﾉ+", "")), F.lit("")).alias("syntax"), fields.joined(fields.kept(F.col("remarks"), g), g).alias("remarks"),
        fields.parameters(F.col("parameters"), g).alias("parameters"), fields.members(F.col("members"), g).alias("members"), fields.return_value(F.col("return_value"), g).alias("return_value"),
        fields.requirements(F.col("requirements"), g).alias("requirements"),
        F.regexp_extract_all(F.array_join(F.transform(see_also, T.strip), " "), F.lit("([A-Za-z_][A-Za-z0-9_]+)"), 1).alias("see_also"),
    )
    earlier = F.array_distinct(F.collect_list("name").over(W.partitionBy(*DOC).orderBy("ord").rowsBetween(W.unboundedPreceding, -1)))
    desc = F.col("description")

    def position(n: Column) -> Column:
        between = F.instr(desc, F.concat(F.lit(" "), n, F.lit(" ")))
        return F.when(between > 0, between).otherwise(F.instr(desc, F.concat(F.lit(" "), n))) - 1

    at = F.filter(F.transform(F.col("earlier"), position), lambda p: (p > 0) & (p > F.length(desc) * 0.6))
    first = F.get(at, F.lit(0))
    return base.withColumn("earlier", earlier).withColumn("description", F.when(first.isNotNull(), T.strip(F.substring(desc, F.lit(1), first))).otherwise(desc)).drop("earlier")


def merged(segments: DataFrame) -> DataFrame:
    """One row per name of a document variant: longest texts, most items, first types and values; requirements key by key."""
    ord_ = -F.col("ord")
    longest = lambda c: F.max_by(c, F.struct(F.coalesce(F.length(c), F.lit(-1)), ord_)).alias(c)
    most = lambda c: F.nullif(F.max_by(c, F.struct(F.coalesce(F.size(c), F.lit(0)), ord_)), F.array().cast(dict(segments.dtypes)[c])).alias(c)
    earliest = lambda value: F.min_by(value, F.when(value.isNotNull(), F.col("ord")))
    latest = lambda value: F.max_by(value, F.when(value.isNotNull(), F.col("ord")))
    keys = ("header", "library", "dll", "target_platform", "min_server", "min_client")
    kept = {k: latest(F.col(f"requirements.{k}")) for k in keys}
    typed = F.when(F.col("entity_type") != "unknown", F.col("entity_type"))
    grouped = segments.groupBy(*DOC, "name").agg(
        F.min("ord").alias("ord"), F.min_by("source_line", "ord").alias("source_line"), F.coalesce(earliest(typed), F.lit("unknown")).alias("entity_type"),
        earliest(F.col("header")).alias("header"), longest("description"), longest("syntax"), longest("remarks"), most("parameters"), most("members"),
        earliest(F.col("return_value")).alias("return_value"), F.struct(*[v.alias(k) for k, v in kept.items()]).alias("requirements"), F.min_by("see_also", "ord").alias("see_also"),
    )
    some = F.coalesce(*[F.col(f"requirements.{k}") for k in keys]).isNotNull()
    return grouped.withColumn("requirements", F.when(some, F.col("requirements")))


def cross_references(rows: DataFrame, names: DataFrame, g: Grammar = OCR) -> DataFrame:
    """(doc_id, src, name, cross_references): names in the texts that are in the lexicon or in the same document.

    Names are met by equi-joins on the name; a third of all references may be to one name, so they are counted per
    entity first and the lexicon side is unique.
    """
    text = F.concat_ws(" ", "description", "remarks")
    found = F.concat(
        F.regexp_extract_all(text, F.lit(rf"(?U)\b({T.ALLCAPS})\b"), 1),
        F.filter(F.regexp_extract_all(text, F.lit(r"(?U)\b([A-Z][a-z][a-zA-Z0-9]{2,})\b"), 1), lambda n: ~T.is_stop_word(n, g)),
        F.coalesce("see_also", F.array().cast("array<string>")),
    )
    refs = rows.select(*DOC, "name", F.explode(F.array_distinct(found)).alias("ref")).where("ref <> name")
    local = rows.select(*DOC, F.col("name").alias("ref")).distinct()
    known = refs.join(names.select(F.col("name").alias("ref")).distinct(), "ref", "left_semi").unionByName(refs.join(local, [*DOC, "ref"], "left_semi"))
    return known.groupBy(*DOC, "name").agg(F.array_sort(F.collect_set("ref")).alias("cross_references"))


def finished(rows: DataFrame, refs: DataFrame, g: Grammar = OCR) -> DataFrame:
    """Entities that have a description, with references, deprecation and confidence."""
    kept = rows.where((F.length("description") >= g.min_description) & ~F.col("description").rlike(T.ARTICLE_META))
    detailed = F.col("parameters").isNotNull() | F.col("members").isNotNull()
    returns = F.col("return_value").isNotNull()
    return kept.join(refs, [*DOC, "name"], "left").select(
        *DOC, "ord", F.concat(F.lit(f"{g.namespace}::"), F.col("name")).alias("id"), "name", "entity_type", "description", "syntax", "parameters", "return_value", "remarks", "members", "requirements",
        "header", F.col("description").rlike("(?iu)已弃用|过时|请勿使用|deprecated").alias("deprecated"), F.coalesce("cross_references", F.array().cast("array<string>")).alias("cross_references"),
        T.confidence(F.col("name"), F.col("description"), F.col("entity_type"), F.col("header"), F.col("syntax"), detailed, returns).alias("confidence"), "source_line",
    )
