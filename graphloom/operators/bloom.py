"""A blocked Bloom filter as a DataFrame, built and probed by built-in expressions only.

A key chooses one block of 4,096 bits and ``probes`` bits within it. The filter is a table (block, words) with
one row per block, so building it is an aggregation with map-side combining and probing it is an equi-join on
the block number.

Its size is proven before it is broadcast: there are at most ``max_blocks`` blocks of 512 bytes, however many
keys there are. Beyond the capacity of that many blocks the rate of false positives rises; a negative stays a proof.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 64
#: 65,536 blocks of 512 bytes: 32 MB, room for 26 million keys at 10 bits each.
MAX_BLOCKS = 65_536


def blocks_for(keys: int, bits_per_key: int = 10, max_blocks: int = MAX_BLOCKS) -> int:
    """Blocks that hold ``keys`` keys, within the bound."""
    return max(1, min(max_blocks, -(-keys * bits_per_key // (WORDS * 64))))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bits(key: Column, probes: int) -> list[Column]:
    second = F.xxhash64(key, F.lit(0x9E3779B9))
    return [F.shiftrightunsigned(second, 12 * i).bitwiseAND(F.lit(WORDS * 64 - 1)).cast("int") for i in range(probes)]


def build(keys: DataFrame, key: str, blocks: int, probes: int = 5) -> DataFrame:
    """Table (block, words) of a Bloom filter over the keys that are not null."""
    bits = keys.where(F.col(key).isNotNull()).select(_block(F.col(key), blocks).alias("block"), F.explode(F.array(*_bits(F.col(key), probes))).alias("bit"))
    words = bits.groupBy("block", F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, bit % 64)")).alias("bits"))
    return words.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("words"))


def probe(refs: DataFrame, key: str, filter_table: DataFrame, blocks: int, probes: int = 5, flag: str = "may_exist") -> DataFrame:
    """``refs`` with ``flag``: false where the key is certainly not among the filter's keys, or null."""
    bits = [F.coalesce(F.expr(f"shiftright(words[shiftright(bit{i}, 6)], bit{i} % 64) & 1L = 1L"), F.lit(False)) for i in range(probes)]
    ready = refs.withColumn("block", _block(F.col(key), blocks)).withColumns({f"bit{i}": b for i, b in enumerate(_bits(F.col(key), probes))})
    hit = bits[0]
    for b in bits[1:]:
        hit = hit & b
    joined = ready.join(F.broadcast(filter_table), "block", "left")
    return joined.withColumn(flag, F.col(key).isNotNull() & hit).drop("block", "words", *(f"bit{i}" for i in range(probes)))
