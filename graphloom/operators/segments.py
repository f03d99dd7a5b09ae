"""The extraction's state machine as windows over a document's lines.

Whether an entity is open before a line depends only on the last boundary above it: a section or header closes, a
line that could open an entity leaves one open either way (it opens one, or one was open and it was a marker).
So no state has to be carried from line to line, and all steps share one partitioning by document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.functions import text as T
from graphloom.operators.lines import DOC

#: The parts of an entity that lines are collected in.
BUCKETS = ("description", "syntax", "parameters", "return_value", "remarks", "members", "requirements", "see_also")


def segment_lines(classified: DataFrame) -> DataFrame:
    """Classified lines that belong to an entity: segment number, section and header there, bucket and content.

    A line that opens an entity has ``starts`` true; its content is what follows the name.
    """
    upto = W.partitionBy(*DOC).orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy(*DOC).orderBy("line_no").rowsBetween(W.unboundedPreceding, -1)
    closes = F.col("section").isNotNull() | F.col("header").isNotNull()
    marker = F.col("at_end").isNotNull() | F.col("at_start").isNotNull()
    edge = F.when(closes, F.lit(False)).when(F.col("named").isNotNull(), F.lit(True))
    kind = F.when(F.col("section").isNotNull(), F.col("section")).when(F.col("header").isNotNull(), F.lit("unknown"))
    state = classified.withColumn("open", F.coalesce(F.last(edge, True).over(before), F.lit(False)))
    state = state.withColumn("starts", F.col("named").isNotNull() & ~(marker & F.col("open")))
    state = state.withColumns(
        {
            "seg": F.sum(F.col("starts").cast("int")).over(upto),
            "in_section": F.coalesce(F.last(kind, True).over(upto), F.lit("unknown")),
            "in_header": F.last("header", True).over(upto),
        }
    )
    held = state.where(~closes & (F.col("open") | F.col("starts")))
    segment = W.partitionBy(*DOC, "seg").orderBy("line_no").rowsBetween(W.unboundedPreceding, -1)
    key = F.when(~F.col("starts"), F.coalesce("at_end.key", "at_start.key"))
    held = held.withColumn("bucket_before", F.coalesce(F.last(key, True).over(segment), F.lit("description")))
    is_marker = ~F.col("starts") & marker
    return held.select(
        *DOC, "line_no", "seg", "starts", "in_section", "in_header", F.col("named.name").alias("opened"),
        F.when(F.col("starts"), F.lit("description")).when(is_marker & F.col("at_start").isNotNull(), F.col("at_start.key")).otherwise(F.col("bucket_before")).alias("bucket"),
        F.when(F.col("starts"), F.col("named.rest")).when(F.col("at_end").isNotNull(), F.col("at_end.before")).when(F.col("at_start").isNotNull(), F.col("at_start.rest")).otherwise(F.col("s")).alias("content"),
        is_marker.alias("marks"),
    )


def segments(held: DataFrame) -> DataFrame:
    """One row per entity opened: name, section, header, first line, and its lines per bucket in order.

    Where the opening line ends with the next entity's name, that entity gets all lines below.
    """
    lines = lambda b: F.transform(F.array_sort(F.collect_list(F.when((F.col("bucket") == b) & (F.col("content") != "") & ~F.col("starts"), F.struct("line_no", "content")))), lambda x: x["content"]).alias(b)
    at_start = lambda c: F.max(F.when(F.col("starts"), F.col(c)))
    grouped = held.groupBy(*DOC, "seg").agg(
        at_start("opened").alias("name"), at_start("content").alias("rest"), at_start("in_section").alias("section"), at_start("in_header").alias("header"),
        at_start("line_no").alias("start_line"), *[lines(b) for b in BUCKETS],
    )
    trail = F.nullif(F.regexp_extract("rest", T.TRAILING_NAME, 1), F.lit(""))
    cut = F.regexp_instr("rest", F.lit(T.TRAILING_NAME))
    rest = F.when(trail.isNotNull(), T.strip(F.substring("rest", F.lit(1), cut))).otherwise(F.col("rest"))
    rest = F.when(rest.startswith(F.col("name")), T.strip(F.substring(rest, F.length("name") + 1, F.lit(1_000_000)))).otherwise(rest)
    head = F.filter(F.array(rest), lambda x: x != "")
    empty = F.array().cast("array<string>")
    parts = lambda own: [F.when(own, F.col(b)).otherwise(empty).alias(b) for b in BUCKETS[1:]]
    no_trail = trail.isNull()
    first = F.struct(F.lit(0).alias("sub"), F.col("name").alias("name"), F.when(no_trail, F.concat(head, F.col("description"))).otherwise(head).alias("description"), *parts(no_trail))
    second = F.struct(F.lit(1).alias("sub"), trail.alias("name"), F.col("description").alias("description"), *parts(F.lit(True)))
    both = F.when(no_trail, F.array(first)).otherwise(F.array(first, second))
    return grouped.select(*DOC, "seg", "section", "header", "start_line", F.explode(both).alias("e")).select(*DOC, "seg", "section", "header", "start_line", "e.*")
