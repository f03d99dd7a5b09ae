"""One surviving row per group of duplicate records, chosen field by field.

A single aggregation takes, for each attribute, the maximum of a composite struct: whether there is a value, the
priority of its source, its time, how complete the value is, the value, and the key of its row. Everything is combined
on the map side first, so a group that holds a third of all rows arrives as one partial row per task.

``found`` comes from the same winners: with all sources of one priority, the winner of each attribute is a row that has it
and is the latest of those; the row that alone is best in every respect is the one that wins every attribute, ties or not.

Defined results. A group is one entity: same ``document_id`` and same folded name; rows whose document is null
or whose name is null or folds to nothing belong to no group. Placeholders count as no value. A confidence that
is null, NaN or outside 0..1 ranks lowest. Ties are broken by the larger value, then row key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.charfold import fold_column

# Texts that stand for an absent value, in lower case and trimmed.
PLACEHOLDERS = ["", "-", "--", "—", "n/a", "na", "null", "none", "nil", "tbd", "无", "暂无", "待补充", "未知"]
#: Trust in the origin of a row, higher wins.
PRIORITY = {"manual": 4, "llm": 3, "p": 2, "t": 1}
#: Optional fields, each kept from the best row that has it, and those that are texts.
OPTIONAL = ("entity_type", "description", "syntax", "remarks", "header", "return_value")
TEXTS = ("description", "syntax", "remarks")


def name_key(name: Column) -> Column:
    """The letters and digits of a name, folded and in lower case, without a namespace prefix."""
    bare = F.regexp_replace(F.lower(fold_column(name)), r"^.*::", "")
    return F.nullif(F.regexp_replace(bare, r"[^\p{L}\p{N}]", ""), F.lit(""))


def value_of(column: Column) -> Column:
    """The column, null where it holds a placeholder."""
    plain = F.trim(F.translate(F.lower(column), "\t\n\r 　", "     "))
    return F.when(~plain.isin(PLACEHOLDERS), column)


def confidence_of(column: Column) -> Column:
    """The confidence, null where it is not within 0..1."""
    return F.when(column.between(0, 1) & ~F.isnan(column), column)


def _keyed(refined: DataFrame) -> DataFrame:
    return (
        refined.select("refined_id", "document_id", "name", "confidence", "origin", "refined_at", *OPTIONAL)
        .withColumn("name_key", name_key(F.col("name")))
        .where("document_id is not null and name_key is not null")
        .withColumns({c: value_of(F.col(c)) for c in OPTIONAL} | {"confidence": confidence_of(F.col("confidence"))})
    )


def _winner(there: Column, *rank: Column) -> Column:
    """Aggregate: the maximum of (there, rank..., value, row key) as a struct."""
    return F.max(F.struct(there.alias("there"), *[c.alias(f"r{i}") for i, c in enumerate(rank)]))


def survivors(refined: DataFrame, priority: dict[str, int] | None = None) -> DataFrame:
    """One row per entity: each attribute's best value, the row count and the latest time.

    Every attribute, ``confidence`` and ``name`` included, is the maximum of (there, source priority, time, value), a longer
    text before a shorter one of the same source and time; a name is there the better the plainer it is written.
    """
    rank = F.coalesce(*[F.when(F.col("origin") == k, F.lit(v)) for k, v in (priority or PRIORITY).items()], F.lit(0))
    at, name = F.col("refined_at"), F.col("name")

    def best(c: str) -> Column:
        value = F.col(c)
        complete = F.length(c) if c in TEXTS else F.lit(0)
        return _winner(value.isNotNull(), rank, at, complete, value)["r3"].alias(c)

    plain = (name == F.trim(fold_column(name))).cast("int") + name.rlike(r"^\w+$").cast("int")
    return (
        _keyed(refined)
        .groupBy("document_id", "name_key")
        .agg(
            _winner(plain, rank, at, name)["r2"].alias("name"), *[best(c) for c in (*OPTIONAL, "confidence")],
            F.max("refined_at").alias("refined_at"), F.count("*").alias("n_rows"), F.min("refined_id").alias("first_id"),
        )
    )


def found(refined: DataFrame) -> DataFrame:
    """refined_id of the rows that alone are best in every respect, in groups of at least two.

    One aggregation, no join back. Each respect (every optional field, confidence, the length of the description, the time)
    has its winner, the maximum of (there or how much, then how many respects the row has and where it stands, row key). A row that is best in every
    respect has the greatest overall standing too, so it wins each of them; it is alone if it also wins where ties go to the lower key.
    """
    measures = [F.col(c).isNotNull() for c in OPTIONAL] + [F.coalesce("confidence", F.lit(-1.0)), F.coalesce(F.length("description"), F.lit(0)), F.coalesce("refined_at", F.lit("0001-01-01").cast("timestamp"))]
    key = F.col("refined_id")
    standing = F.struct(*[m.alias(f"m{i}") for i, m in enumerate(measures)])
    winners = [_winner(m, standing, key)["r1"].alias(f"by_{i}") for i, m in enumerate(measures)]
    low = -_winner(standing, -key)["r0"]
    groups = _keyed(refined).where("refined_id is not null").groupBy("document_id", "name_key").agg(F.count("*").alias("n_rows"), low.alias("low"), *winners)
    alone = F.col("n_rows") >= 2
    for i in range(len(measures)):
        alone = alone & (F.col(f"by_{i}") == F.col("low"))
    return groups.where(alone).select(F.col("low").alias("refined_id"))
