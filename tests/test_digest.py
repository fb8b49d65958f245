"""Snapshots by digests against the comparison of all rows."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.plans import apply as A
from tidemark.plans.digest import DigestTarget

SCHEMA = "k int, v string, m map<string,int>"


def snapshot(seed, size=200):
    draw = random.Random(seed)
    keys = draw.sample(range(300), size)
    return [(k if k else None, draw.choice(["a", "b", None]), draw.choice([None, {"x": 1}])) for k in keys]


def test_changes_equal_the_plain_comparison(spark, tmp_path):
    target = DigestTarget(spark, str(tmp_path / "t"), ["k"])
    assert rows(target.changes(spark.createDataFrame(snapshot(1), SCHEMA)).select("k", "change"))[0][1] == "insert"
    for seed in (1, 2, 3):
        new = spark.createDataFrame(snapshot(seed), SCHEMA)
        if target.log.load().version:
            plain = A.snapshot_changes(target.state(), new, ["k"])
            assert rows(target.changes(new)) == rows(plain)
        target.replace(new)
        assert rows(target.state()) == rows(new)
    assert target.changes(spark.createDataFrame([], SCHEMA)).where("change <> 'delete'").isEmpty()
    target.replace(spark.createDataFrame([], SCHEMA))
    assert target.state().isEmpty()


def test_only_unequal_leaves_are_read_and_written(spark, tmp_path):
    target = DigestTarget(spark, str(tmp_path / "t"), ["id"])
    whole = spark.range(20000).select("id", F.lit("x").alias("v"))
    assert len(target.replace(whole).leaves) == 256
    before = set(target.log.load().runs)
    seen = target.replace(whole.withColumn("v", F.when(F.col("id") == 77, "y").otherwise(F.col("v"))).repartition(3))
    assert len(seen.leaves) == 1 and 0 < seen.read_bytes * 100 < seen.stored_bytes
    after = set(target.log.load().runs)
    assert len(after - before) == len(before - after) == 1
    assert target.state().where("v = 'y'").count() == 1
    assert target.replace(target.state()).leaves == []


def test_columns_of_a_snapshot_may_change(spark, tmp_path):
    target = DigestTarget(spark, str(tmp_path / "t"), ["id"], depth=1)
    target.replace(spark.createDataFrame([(1, 1), (2, 2)], "id int, v int"))
    target.replace(spark.createDataFrame([(1, 10**12), (2, 2)], "id int, v long"))
    assert rows(target.state()) == [(1, 10**12), (2, 2)]
    wider = spark.createDataFrame([(1, "t", 1.5), (3, None, None)], "id long, v string, w double")
    assert rows(target.changes(wider)) == [(1, "t", 1.5, "update"), (2, "2", None, "delete"), (3, None, None, "insert")]
    target.replace(wider)
    assert rows(DigestTarget(spark, str(tmp_path / "t")).state()) == [(1, "t", 1.5), (3, None, None)]
