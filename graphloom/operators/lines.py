"""Documents as lines, and what each line is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.functions import text as T
from graphloom.grammar import OCR, Grammar

#: Columns that name one variant of one document.
DOC = ("doc_id", "src")


def explode_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per line of ``docs``, numbered from 0; line ends of any kind. A null text has no line."""
    whole = F.regexp_replace(F.col(text), "\r\n?", "\n")
    return docs.select(*[c for c in docs.columns if c != text], F.posexplode(F.split(whole, "\n", -1)).alias("line_no", "text"))


def title(lines: DataFrame, g: Grammar = OCR) -> DataFrame:
    """Per document the first line among the first 20 that is no noise and no file name, without a date."""
    t = T.strip(F.regexp_replace(T.strip(F.col("text")), r"(?U)项目\s*\d{4}/\d{2}/\d{2}", ""))
    kept = lines.where(F.col("line_no") < 20).where(~T.is_noise(F.col("text"), g) & ~T.strip(F.col("text")).startswith("[OCR]")).withColumn("t", t).where("t <> ''")
    return kept.groupBy(*DOC).agg(F.min_by("t", "line_no").alias("title"))


def headers_referenced(lines: DataFrame) -> DataFrame:
    """Per document the header files listed in its first 60 lines, sorted and distinct.

    A zone opens at a line that announces headers and closes at the first other line without one; it may open again.
    """
    names = F.regexp_extract_all("text", F.lit(r"(?U)\b([\w\-]+\.h)\b"), 1)
    opens, blank, none = F.col("text").contains("以下标头"), T.strip(F.col("text")) == "", F.size(names) == 0
    edge = F.when(opens, F.lit(True)).when(~blank & none, F.lit(False))
    before = W.partitionBy(*DOC).orderBy("line_no").rowsBetween(W.unboundedPreceding, -1)
    zoned = lines.where(F.col("line_no") < 60).withColumn("edge", edge).withColumn("open", opens | F.coalesce(F.last("edge", True).over(before), F.lit(False)))
    return zoned.where("open").select(*DOC, F.explode(names).alias("h")).groupBy(*DOC).agg(F.array_sort(F.collect_set("h")).alias("headers_referenced"))


def classify(lines: DataFrame, g: Grammar = OCR) -> DataFrame:
    """``lines`` without noise and metadata, with what each opens.

    Adds s (stripped text), section, header, at_end, at_start and named. The first two exclude the others. Whether
    camel-case names are allowed is told per document by a section word among its first lines.
    """
    doc = W.partitionBy(*DOC)
    base = lines.withColumn("s", T.strip(F.col("text"))).withColumn("section", T.section_type(F.col("s"), g))
    camel: Column = F.lit(True)
    if g.head_lines:
        base = base.withColumn("camel", F.coalesce(F.bool_or((F.col("line_no") < g.head_lines) & F.col("section").isNotNull()).over(doc), F.lit(False)))
        camel = F.col("camel")
    base = base.where(~T.is_noise(F.col("text"), g)).withColumn("header", F.when(F.col("section").isNull(), T.header_name(F.col("s"))))
    base = base.where(F.col("section").isNotNull() | F.col("header").isNotNull() | ~T.is_meta(F.col("s")))
    plain = F.col("section").isNull() & F.col("header").isNull()
    at_end = T.part_at_end(F.col("s"), g)
    return (
        base.withColumn("at_end", F.when(plain, at_end))
        .withColumn("at_start", F.when(plain & F.col("at_end").isNull(), T.part_opened(F.col("s"), g)))
        .withColumn("named", F.when(plain, T.name_opened(F.col("s"), camel, g)))
    )


def lexicon(classified: DataFrame) -> DataFrame:
    """Distinct names that lines open, whatever part they stand in."""
    return classified.where("named is not null").select(F.col("named.name").alias("name")).distinct()
