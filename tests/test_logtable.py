"""Log-structured targets against a plain dictionary, and their versions, columns, layout and feed."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tidemark.plans import apply as A
from tidemark.plans import commits, curve
from tidemark.plans.commits import Conflict
from tidemark.plans.evolution import Field, common_type, evolved
from tidemark.plans.logtable import LogTarget, replayed

SCHEMA = "k int, s int, v string, _deleted boolean"


def parquet_files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def drawn_batches(seed, batches=6, size=40, keys=25):
    draw = random.Random(seed)
    key = lambda: draw.choice([None, *range(keys)])
    return [[(key(), draw.randint(0, 40), f"v{draw.randint(0, 3)}", draw.random() < 0.2) for _ in range(size)] for _ in range(batches)]


@pytest.mark.parametrize("options", [{"fanout": 3, "split_bytes": 4000}, {"fanout": 100, "cluster_by": ["s", "v"], "file_rows": 4}])
def test_batches_equal_one_merge(spark, tmp_path, options):
    """Late rows, ties, tombstones and null keys, in batches and compactions, give what one merge of all rows gives."""
    batches = drawn_batches(1)
    target = LogTarget(spark, str(tmp_path / "t"), ["k"], ["s"], feed=True, **options)
    for number, data in enumerate(batches):
        assert target.apply(spark.createDataFrame(data, SCHEMA), batch_id=number)
    everything = spark.createDataFrame([r for b in batches for r in b], SCHEMA)
    expected = rows(A.current_rows(A.winners(A.as_changes(everything), ["k"], ["s"])).select("k", "s", "v"))
    assert rows(target.read().select("k", "s", "v")) == expected
    assert rows(replayed(target.changes(0)).select("k", "s", "v")) == expected
    again = LogTarget(spark, str(tmp_path / "t"))
    assert not again.apply(spark.createDataFrame(batches[3], SCHEMA), batch_id=3)
    again.compact(full=True)
    assert rows(again.read().select("k", "s", "v")) == expected
    assert all(r.base for r in again.log.load().runs.values())
    some = [r for r in expected if r[1] is not None and 10 <= r[1] <= 20]
    assert rows(again.read(("s", 10, 20)).select("k", "s", "v")) == some
    again.apply(spark.createDataFrame([(1, 99, "new", False), (2, -1, "late", False)], SCHEMA), "more", compact=False)
    assert (1, 99, "new") in rows(again.read(("s", 90, None)).select("k", "s", "v"))
    assert rows(again.read(("s", None, -1)).select("k", "s", "v")) == []


def test_history_equals_one_computation(spark, tmp_path):
    batches = drawn_batches(2, batches=4)
    target = LogTarget(spark, str(tmp_path / "t"), ["k"], ["s"], scd=2, fanout=3, split_bytes=6000)
    for data in batches:
        target.apply(spark.createDataFrame(data, SCHEMA))
    everything = spark.createDataFrame([r for b in batches for r in b], SCHEMA)
    expected = rows(A.history_rows(A.scd2_state(everything, ["k"], ["s"])).select("k", "s", "v", A.FROM, A.TO))
    assert rows(target.read().select("k", "s", "v", A.FROM, A.TO)) == expected
    target.compact(full=True)
    assert rows(target.read().select("k", "s", "v", A.FROM, A.TO)) == expected


def test_a_small_batch_writes_one_small_file(spark, tmp_path):
    target = LogTarget(spark, str(tmp_path / "t"), ["id"], ["s"], split_bytes=20000)
    big = spark.range(20000).select("id", F.lit(0).alias("s"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    target.apply(big)
    target.compact(full=True)
    before = set(parquet_files(str(tmp_path / "t" / "data")))
    assert len(target.log.load().inner) == 1 and len(before) >= 16
    target.apply(spark.createDataFrame([(7, 1, "x")], "id long, s int, v string"))
    new = set(parquet_files(str(tmp_path / "t" / "data"))) - before
    assert len(new) == 1 and os.path.getsize(new.pop()) < 5000
    assert target.read().count() == 20000 and target.read().where("id = 7").first()["v"] == "x"


def test_fifty_batches_before_and_after_compaction(spark, tmp_path):
    target = LogTarget(spark, str(tmp_path / "t"), ["id"], ["s"], fanout=10)
    for n in range(50):
        target.apply(spark.range(n, n + 3).select("id", F.lit(n).alias("s")))
    found = rows(target.read())
    assert found == sorted([(i, min(i, 49)) for i in range(52)], key=repr)
    assert len(target.log.load().runs) < 25
    target.compact(full=True)
    assert rows(target.read()) == found and len(target.log.load().runs) == 1


def test_versions_stay_readable_until_they_are_let_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "FULL_EVERY", 4)
    target = LogTarget(spark, str(tmp_path / "t"), ["id"], ["s"], fanout=3, keep=4, feed=True, keep_feed=3)
    counts = {}
    for n in range(13):
        target.apply(spark.range(n, n + 1).select("id", F.lit(n).alias("s")))
        counts[target.log.load().version] = n + 1
    newest = target.log.load().version
    assert target.read(version=newest - 1).count() >= 12
    with pytest.raises(ValueError, match="not kept"):
        target.read(version=1)
    assert min(target.log.versions()) > 1
    with pytest.raises(ValueError, match="not kept"):
        target.changes(0)
    held = {r.path.split("/")[1] for v in target.log.versions()[-4:] for r in target.log.load(v).runs.values()}
    assert held <= set(os.listdir(tmp_path / "t" / "data")) and len(os.listdir(tmp_path / "t" / "data")) < 13


def test_two_writers(spark, tmp_path):
    one, two = (LogTarget(spark, str(tmp_path / "t"), ["id"], ["s"]) for _ in range(2))
    make = lambda i: spark.createDataFrame([(i, 1)], "id int, s int")
    one.apply(make(1), "one")
    stale = two.log.load()
    one.apply(make(2), "one")
    with pytest.raises(Conflict):
        two.log.commit(stale, {"kind": "apply"})
    two.apply(make(3), "two")
    assert rows(one.read()) == [(1, 1), (2, 1), (3, 1)]


def test_a_writer_that_dies_leaves_nothing_to_see(spark, tmp_path, monkeypatch):
    target = LogTarget(spark, str(tmp_path / "t"), ["id"], ["s"])
    target.apply(spark.createDataFrame([(1, 1)], "id int, s int"), batch_id=0)
    monkeypatch.setattr(target.log, "commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        target.apply(spark.createDataFrame([(2, 1)], "id int, s int"), batch_id=1)
    again = LogTarget(spark, str(tmp_path / "t"))
    assert rows(again.read()) == [(1, 1)]
    assert again.apply(spark.createDataFrame([(2, 1)], "id int, s int"), batch_id=1)
    assert rows(again.read()) == [(1, 1), (2, 1)]


def test_columns_change_over_three_batches(spark, tmp_path):
    target = LogTarget(spark, str(tmp_path / "t"), ["id"], ["s"], cluster_by=["n"], feed=True)
    target.apply(spark.createDataFrame([(1, 1, 5, (1,), [1])], "id int, s int, n int, st struct<a:int>, arr array<int>"))
    target.compact(full=True)
    target.apply(spark.createDataFrame([(2, 1, 10**12, (2, "b"), [2**40])], "id long, s int, n long, st struct<a:long,b:string>, arr array<long>"))
    target.apply(spark.createDataFrame([(3, 1, "text", (None, "c"))], "id int, s int, n string, st struct<z:string,b:string>"))
    target.rename("n", "label")
    target.rename("id", "key")
    expected = [(1, "5", (1, None, None), [1]), (2, str(10**12), (2, "b", None), [2**40]), (3, "text", (None, "c", None), None)]
    shown = lambda t: [(r["key"], r["label"], tuple(r["st"]), r["arr"]) for r in t.read().orderBy("key").collect()]
    assert shown(target) == expected
    assert {f.name: f.dataType.simpleString() for f in target.read().schema}["label"] == "string"
    assert rows(target.read(("label", "5", "5")).select("key")) == [(1,)]
    again = LogTarget(spark, str(tmp_path / "t"))
    assert again.keys == ["key"]
    again.apply(spark.createDataFrame([(1, 2, "six")], "key int, s int, label string"))
    assert again.read().where("key = 1").first()["label"] == "six"
    assert [r["after"]["label"] for r in again.changes(0).where("key.key = 1").orderBy("_version").collect()] == ["5", "six"]
    again.drop("arr")
    again.compact(full=True)
    again.apply(spark.createDataFrame([(4, 1, ["x"])], "key int, s int, arr array<string>"))
    assert [r["arr"] for r in again.read().orderBy("key").collect()] == [None, None, None, ["x"]]


def test_columns_that_cannot_change(spark, tmp_path):
    target = LogTarget(spark, str(tmp_path / "t"), ["id"], ["s"])
    target.apply(spark.createDataFrame([(1, 1, [1])], "id int, s int, v array<int>"))
    for bad, schema in (([(1, 1, 5)], "id int, s int, v int"), ([(1.5, 1, [1])], "id double, s int, v array<int>")):
        with pytest.raises(TypeError):
            target.apply(spark.createDataFrame(bad, schema))
    with pytest.raises(ValueError):
        target.apply(spark.createDataFrame([(1,)], "id int"))
    for change in (lambda: target.drop("id"), lambda: target.rename("gone", "x"), lambda: target.rename("v", "s")):
        with pytest.raises(ValueError):
            change()
    assert rows(target.read()) == [(1, 1, [1])]


def test_common_types():
    i, long, d, s = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
    assert common_type(i, long) == long and common_type(long, i) == long and common_type(i, d) == d
    assert common_type(long, d) == s  # a double cannot hold every long
    assert common_type(T.DecimalType(10, 2), long) == T.DecimalType(22, 2) and common_type(T.DecimalType(38, 20), long) == s
    assert common_type(T.DateType(), T.TimestampType()) == T.TimestampType() and common_type(T.BooleanType(), i) == s
    with pytest.raises(TypeError):
        common_type(T.BinaryType(), s)
    fields = evolved([], T.StructType([T.StructField("a", i), T.StructField("b", T.NullType())]))
    assert [(f.id, f.name, f.type) for f in fields] == [(1, "a", i), (2, "b", s)] and Field.of(fields[0].as_list()) == fields[0]


def test_a_filter_on_two_columns_opens_few_files(spark, tmp_path):
    target = LogTarget(spark, str(tmp_path / "t"), ["id"], ["s"], cluster_by=["x", "y"], file_rows=300, split_bytes=1 << 40)
    noise = lambda n: F.pmod(F.xxhash64("id", F.lit(n)), F.lit(1000))
    data = spark.range(20000).select("id", F.lit(1).alias("s"), F.when(F.col("id") % 50 > 0, noise(1)).alias("x"), noise(2).cast("string").alias("y"))
    target.apply(data)
    target.compact(full=True)
    ranges = (("x", 100, 199), ("y", "3", "39"))
    opened, there = target.files(*ranges)
    assert there >= 60 and opened * 10 < there
    assert rows(target.read(*ranges).select("id")) == rows(data.where("x between 100 and 199 and y between '3' and '39'").select("id"))
    plan = target.read(*ranges)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqu" in plan  # row groups inside a file are skipped too


def test_curve_keeps_neighbours_together(spark):
    grid = spark.range(4096).select((F.col("id") % 64).alias("a"), F.expr("id div 64").alias("b"))
    cuts = curve.cut_points(grid, ["a", "b"], 4096)
    placed = grid.withColumn("z", curve.place_on_curve(grid, cuts))
    assert placed.select("z").distinct().count() == 4096
    wide = placed.groupBy(F.expr("z div 64").alias("part")).agg((F.max("a") - F.min("a")).alias("da"), (F.max("b") - F.min("b")).alias("db"))
    assert wide.agg(F.max("da"), F.max("db")).first() == (7, 7)


def test_empty_batches(spark, tmp_path):
    target = LogTarget(spark, str(tmp_path / "t"), ["id"], ["s"], feed=True)
    with pytest.raises(ValueError):
        target.read()
    target.apply(spark.createDataFrame([], "id int, s int"))
    assert rows(target.read()) == [] and target.files() == (0, 0) and target.compact(full=True) == 0
    target.apply(spark.createDataFrame([(1, 1)], "id int, s int"))
    target.apply(spark.createDataFrame([], "id int, s int"))
    assert rows(target.read()) == [(1, 1)] and target.changes(2).count() == 0
