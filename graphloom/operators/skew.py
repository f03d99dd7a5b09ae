"""Joins that survive a key holding a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, key: str, share: float = 0.02) -> list:
    """Keys that hold more than ``share`` of the rows: fewer than 1 / share of them, whatever the size."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    return [r[0] for r in counts.where(F.col("count") > share * total).select(key).collect()] if total else []


def left_join_unique(left: DataFrame, right: DataFrame, key: str, hot: list) -> DataFrame:
    """Left join with a right side that is unique by ``key``; ``hot`` comes from ``hot_keys``.

    Rows of hot keys meet their right rows, one per hot key, by broadcast, so they stay where they are; all others are joined by shuffle. No row is left out of either part.
    """
    if not hot:
        return left.join(right, key, "left")
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    return left.where(is_hot).join(F.broadcast(right.where(F.col(key).isin(hot))), key, "left").unionByName(left.where(~is_hot).join(right, key, "left"))
