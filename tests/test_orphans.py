"""Bloom filter and orphan references."""

import datetime as dt

from pyspark.sql import functions as F

from graphloom.operators import bloom, orphans
from graphloom.operators.skew import hot_keys, left_join_unique

DAY = lambda n: dt.datetime(2025, 1, 1) + dt.timedelta(days=n)


def test_bloom_has_no_false_negative_and_few_false_positives(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"))
    refs = spark.range(10000).select(F.concat(F.lit("k"), "id").alias("k")).unionByName(spark.createDataFrame([(None,)], "k string"))
    n = bloom.blocks_for(5000)
    hit = bloom.probe(refs, "k", bloom.build(keys, "k", n), n)
    assert hit.join(keys, "k", "left_semi").where(~F.col("may_exist")).count() == 0
    assert hit.join(keys, "k", "left_anti").where("may_exist").count() < 300
    assert bloom.blocks_for(10**12) == bloom.MAX_BLOCKS


def test_bloom_probe_agrees_beyond_its_capacity(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"))
    hit = bloom.probe(keys, "k", bloom.build(keys, "k", 1), 1)
    assert hit.where(~F.col("may_exist")).count() == 0


def test_join_with_a_hot_key(spark):
    left = spark.range(1000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id")
    right = spark.createDataFrame([("hot", 1), ("1", 2)], "k string, v int")
    assert hot_keys(left, "k") == ["hot"]
    out = left_join_unique(left, right, "k", ["hot"])
    assert out.count() == 1000 and out.where("v = 1").count() == 334 and out.where("v = 2").count() == 1


def tables(spark):
    e = spark.createDataFrame(
        [(1, "d1", ["A", "B", None, ""], DAY(5)), (2, "d2", None, DAY(5)), (3, None, [], DAY(1)), (4, "", ["A"], None), (1, "d1", ["A", "B", None, ""], DAY(5))],
        "rec_id long, document_id string, cross_references array<string>, extracted_at timestamp",
    )
    g = spark.createDataFrame([(1, 1, "A", DAY(20)), (2, 9, None, DAY(5)), (3, None, "", DAY(5)), (4, 2, "a", DAY(5))], "edge_id long, rec_id long, target string, created_at timestamp")
    n = spark.createDataFrame([("A", DAY(0), DAY(10)), ("A", DAY(0), DAY(10)), ("A", DAY(30), None), (None, DAY(0), None)], "name string, indexed_at timestamp, removed_at timestamp")
    s = spark.createDataFrame([("d1", DAY(0), None), ("d2", DAY(6), None)], "document_id string, registered_at timestamp, withdrawn_at timestamp")
    return e, g, n, s


def test_orphans(spark):
    got = {tuple(r) for r in orphans.found(*tables(spark)).collect()}
    assert got == {
        ("entities", 1, "cross_references", "B"), ("entities", 4, "cross_references", "A"), ("entities", 2, "document_id", "d2"),
        ("edges", 1, "target", "A"), ("edges", 4, "target", "a"), ("edges", 2, "rec_id", "9"),
    }
    assert sum(r.orphans for r in orphans.report(*tables(spark)).collect()) == 6


def test_orphans_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(orphans, "BROADCAST_KEYS", 0)
    assert orphans.found(*tables(spark)).count() == 6


def test_orphans_of_empty_tables(spark):
    e, g, n, s = tables(spark)
    assert orphans.found(e.limit(0), g.limit(0), n, s).count() == 0
    assert orphans.found(e, g, n.limit(0), s.limit(0)).where("column_name = 'cross_references'").count() == 3
