"""Sources mixed to target weights, interleaved by Pfair scheduling.

Sizes are tokens of a public tokenizer. The mix is as large as the scarcest source allows: no source gives more than
``max_repeats`` times what it has, and all present sources keep their target weights among one another. It is cut
into ``blocks`` equal blocks; the j-th block of a source with weight w is released at floor((j - 1) / w) and due at
ceil(j / w), and each slot goes to the released block that is due first. Thus after any number of slots every
source is within one block of its weight.

That holds for what is delivered, too: a source's chosen texts are one stream of tokens, cut into its blocks, so every slot
holds a full block of one source and a text that reaches over the end of a block goes on in the source's next slot. ``spans`` tells for
each text and copy which of its tokens stand in which slot.

Only one number per source and the schedule, both bounded, reach the driver. Positions within a source are prefix
sums in two levels, over buckets and within them, so a source with most of the rows is never one task's window.

Defined results. Equal texts of one source are one text, used at most ``max_repeats`` times together; the lowest
doc_id stands for them. Null and empty texts, null sources and sources without a positive weight give no rows.
A target whose source has no text is reported with share 0, its weight going to the others in proportion. Every present
source has at least one block.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.llm.encode import token_counts
from graphloom.session import materialize, small_batches

BLOCKS = 10_000
#: Sources that may be mixed: their plan is held on the driver.
MAX_SOURCES = 10_000
#: Texts of one bucket, about.
BUCKET = 200_000


def schedule(weights: list[int]) -> list[int]:
    """Source number of each slot, for sources that get ``weights[s]`` of sum(weights) blocks."""
    total = sum(weights)
    pace = [Fraction(total, w) if w else None for w in weights]
    waiting = [(0, s, 1) for s, w in enumerate(weights) if w]
    heapq.heapify(waiting)
    due: list[tuple[int, int, int]] = []
    slots = []
    for t in range(total):
        while waiting and waiting[0][0] <= t:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(due, (math.ceil(j * pace[s]), s, j))
        _, s, j = heapq.heappop(due)
        slots.append(s)
        if j < weights[s]:
            heapq.heappush(waiting, (math.floor(j * pace[s]), s, j + 1))
    return slots


def apportion(shares: list[float], blocks: int) -> list[int]:
    """Whole blocks in proportion to the shares, at least one each, summing to ``blocks`` (or more, if there are more sources): largest remainders get the rest."""
    exact = [s / sum(shares) * blocks for s in shares]
    out = [max(1, math.floor(x)) for x in exact]
    for i in sorted(range(len(out)), key=lambda i: out[i] - exact[i])[: max(0, blocks - sum(out))]:
        out[i] += 1
    return out


def characters(df: DataFrame, *columns: str) -> DataFrame:
    """A measure of texts for ``pool``: their characters."""
    return df.select(*columns, F.length("text").cast("long").alias("n_tokens"))


def pool(docs: DataFrame, targets: DataFrame, measure: Callable[..., DataFrame] = token_counts) -> DataFrame:
    """(source, doc_id, n_tokens): the distinct texts of the sources that have a target; ValueError if those are too many."""
    small_batches(docs.sparkSession)
    wanted = targets.where("source is not null and target_share > 0").select("source").distinct()
    if wanted.limit(MAX_SOURCES + 1).count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    kept = docs.select("doc_id", "source", "text").where("text is not null and text <> ''").join(F.broadcast(wanted), "source", "left_semi").withColumn("digest", F.md5("text"))
    counted = measure(kept, "source", "digest", "doc_id")
    return counted.groupBy("source", "digest").agg(F.min(F.struct("doc_id", "n_tokens")).alias("m")).select("source", "m.doc_id", "m.n_tokens")


def _plan(held: DataFrame, targets: DataFrame, blocks: int) -> list[dict]:
    """Per present source: size, need, blocks and slots."""
    sizes = {r["source"]: r["size"] for r in held.groupBy("source").agg(F.sum("n_tokens").alias("size")).collect()}
    rows = [r.asDict() for r in targets.where("source is not null and target_share > 0").groupBy("source").agg(F.max("target_share").alias("share"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("most")).orderBy("source").collect()]
    rows = [r | {"size": sizes[r["source"]]} for r in rows if sizes.get(r["source"]) and r["most"] > 0]
    if not rows:
        return []
    whole = sum(r["share"] for r in rows)
    total = min(r["size"] * r["most"] * whole / r["share"] for r in rows)
    counts = apportion([r["share"] for r in rows], blocks)
    slots = schedule(counts)
    for i, (r, n) in enumerate(zip(rows, counts)):
        r |= {"need": min(total * r["share"] / whole, float(r["size"] * r["most"])), "blocks": n, "slots": [t for t, s in enumerate(slots) if s == i]}
    return rows


def _placed(held: DataFrame, texts: int) -> DataFrame:
    """``held`` with the tokens before each text in its source, in an order that depends on doc_id alone."""
    buckets = max(16, min(65_536, texts // BUCKET))
    spread = held.withColumn("h", F.md5(F.concat(F.col("doc_id").cast("string"), F.lit("mix")))).withColumn("bucket", F.floor(F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * buckets / (1 << 32)).cast("int"))
    sums = spread.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("n"))
    before = sums.select("source", "bucket", (F.sum("n").over(W.partitionBy("source").orderBy("bucket")) - F.col("n")).alias("before"))
    inside = W.partitionBy("source", "bucket").orderBy("h", "doc_id")
    return spread.withColumn("within", F.sum("n_tokens").over(inside) - F.col("n_tokens")).join(before, ["source", "bucket"]).select("source", "doc_id", "n_tokens", (F.col("before") + F.col("within")).alias("start"))


def chosen(held: DataFrame, plan: list[dict]) -> DataFrame:
    """(source, doc_id, n_tokens, start, size, blocks, slots, repeats): the texts used, and where they stand in their source."""
    schema = "source string, size long, need double, blocks int, slots array<int>"
    small = held.sparkSession.createDataFrame([(r["source"], r["size"], r["need"], r["blocks"], r["slots"]) for r in plan], schema)
    full = F.floor(F.col("need") / F.col("size"))
    repeats = (full + (F.col("start") < F.col("need") - full * F.col("size")).cast("long")).cast("int")
    return _placed(held, held.count()).join(F.broadcast(small), "source").withColumn("repeats", repeats).where("repeats > 0").drop("need")


def mix(docs: DataFrame, targets: DataFrame, blocks: int = BLOCKS, measure: Callable[..., DataFrame] = token_counts) -> DataFrame:
    """(doc_id, source, n_tokens, repeats, spans): the chosen texts, how often, and for each copy the slots of its tokens.

    A span (copy, slot, begin, end) holds the tokens from ``begin`` up to ``end`` of one copy. There are as many spans as copies and blocks
    together, so their number does not depend on how long texts are.
    """
    held = materialize(pool(docs, targets, measure).where("n_tokens > 0"))
    used = materialize(chosen(held, _plan(held, targets, blocks)))
    sums = used.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("given"))  # one row per source, at most MAX_SOURCES
    rows = used.join(F.broadcast(sums), "source")
    span = """flatten(transform(sequence(0, repeats - 1), c -> transform(
        sequence((c * size + start) * blocks div given, (c * size + start + n_tokens - 1) * blocks div given),
        k -> struct(c AS copy, slots[k] AS slot, greatest(0L, (k * given + blocks - 1) div blocks - c * size - start) AS begin,
            least(n_tokens, ((k + 1) * given + blocks - 1) div blocks - c * size - start) AS end))))"""
    return rows.select("doc_id", "source", "n_tokens", "repeats", F.expr(span).alias("spans"))


def shares(docs: DataFrame, targets: DataFrame, measure: Callable[..., DataFrame] = token_counts) -> DataFrame:
    """Per target: texts and copies chosen, their tokens, the target share and the actual share."""
    held = materialize(pool(docs, targets, measure).where("n_tokens > 0"))
    used = chosen(held, _plan(held, targets, BLOCKS)).groupBy("source").agg(F.count("*").alias("n_texts"), F.sum("repeats").alias("n_copies"), F.sum(F.col("n_tokens") * F.col("repeats")).alias("n_tokens"), F.max("repeats").alias("most_repeats"))
    all_ = targets.join(used, "source", "left").fillna(0, ["n_texts", "n_copies", "n_tokens", "most_repeats"])
    total = F.sum("n_tokens").over(W.partitionBy(F.lit(1)))
    return all_.select("source", "target_share", "max_repeats", "n_texts", "n_copies", "n_tokens", "most_repeats", F.coalesce(F.try_divide(F.col("n_tokens"), total), F.lit(0.0)).alias("actual_share"))
