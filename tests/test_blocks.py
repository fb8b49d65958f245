"""Block windows against plain windows and brute force, with skewed keys."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import aggregate as Ag
from tidemark.operators import paging as P
from tidemark.operators import timeseries as Ts
from tidemark.plans import blocks as B


@pytest.fixture(scope="module")
def skewed(spark):
    return spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("tag"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 97 % 5003).alias("ts"),
        F.col("id"),
        (F.col("id") * 31 % 101).cast("double").alias("value"),
    ).cache()


@pytest.mark.parametrize("blocks,hot_rows", [(1, 100), (2, 100), (8, 0), (100, 30), (8, 5000)])
def test_neighbours(skewed, blocks, hot_rows):
    split = B.find_split(skewed, ["tag"], "ts", blocks, hot_rows)
    assert split.plain == (blocks == 1 or hot_rows > 700)
    got = B.neighbours(
        skewed, ["tag"], ["ts", "id"], lambda w: {"p": F.lag("id").over(w), "n": F.lead("id").over(w)}, split=split
    )
    w = Window.partitionBy("tag").orderBy("ts", "id")
    want = skewed.withColumns({"p": F.lag("id").over(w), "n": F.lead("id").over(w)})
    assert rows(got.select(*want.columns)) == rows(want)


@pytest.mark.parametrize("blocks,hot_rows", [(4, 5000), (4, 100), (64, 0)])
def test_running_position(skewed, blocks, hot_rows):
    split = B.find_split(skewed, ["tag"], "ts", blocks, hot_rows)
    got = B.running_position(skewed, ["ts", "id"], "at", F.col("id"), keys=["tag"], split=split)
    w = Window.partitionBy("tag").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumn("at", F.sum("id").over(w))
    assert rows(got.select("id", "at")) == rows(want.select("id", "at"))


def test_no_block_is_larger_than_its_share(skewed):
    cuts = B.order_cuts(skewed, "ts", 16)
    assert len(cuts) == 15
    blocked = skewed.withColumn(B.BLOCK, B.block_of(B.comparable(skewed, "ts"), cuts))
    sizes = blocked.groupBy(B.BLOCK).count().agg(F.max("count")).first()[0]
    assert sizes <= 2000 / 16 * 1.5


def test_pages_cover_everything_once(spark, skewed):
    pages = [P.page(skewed.select("ts", "id"), ["ts", "id"], n, 300) for n in range(1, 8)]
    ids = [r["id"] for p in pages for r in p.collect()]
    assert len(ids) == 2000 and len(set(ids)) == 2000
    assert {r["next_page"] for r in pages[0].collect()} == {2}
    assert {r["next_page"] for r in pages[-1].collect()} == {None}


def test_balanced_bins(spark):
    items = spark.range(500).select("id", (F.when(F.col("id") == 7, 400).otherwise(F.col("id") % 9 + 1)).alias("w"))
    sizes = Ag.balance_partitions(items, "id", "w", 6).groupBy("bin").agg(F.sum("w").alias("s")).collect()
    total = sum(r["s"] for r in sizes)
    assert {r["bin"] for r in sizes} <= set(range(6))
    assert max(r["s"] for r in sizes) <= total / 6 + 400


@pytest.mark.parametrize("hot_rows", [100, 10000])
def test_interpolation_against_brute_force(spark, skewed, monkeypatch, hot_rows):
    monkeypatch.setattr(B, "HOT_ROWS", hot_rows)
    start, end = datetime(2024, 1, 1), datetime(2024, 1, 1, 1, 30)
    got = Ts.ts_interpolate(skewed, "tag", "ts", "value", start, end, 60)
    points: dict = {}
    for r in skewed.collect():
        held = points.setdefault(r["tag"], {})
        held[r["ts"]] = max(held.get(r["ts"], r["value"]), r["value"])
    want = []
    for tag, held in points.items():
        times = sorted(held)
        for step in range(91):
            at = datetime.fromtimestamp(start.timestamp() + 60 * step)
            before = [x for x in times if x <= at]
            after = [x for x in times if x >= at]
            value = None
            if before and after:
                a, b = before[-1], after[0]
                value = held[a]
                if a != b:
                    value += (held[b] - held[a]) * (at - a).total_seconds() / (b - a).total_seconds()
            want.append((tag, at, None if value is None else round(value, 6)))
    got_rows = [(r["tag"], r["timestamp"], None if r["value"] is None else round(r["value"], 6)) for r in got.collect()]
    assert sorted(got_rows, key=repr) == sorted(want, key=repr)


def test_single_point_series(spark):
    df = spark.createDataFrame([("t", datetime(2024, 1, 1, 0, 1), 5.0)], "tag string, ts timestamp, value double")
    got = Ts.ts_interpolate(df, "tag", "ts", "value", datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 2), 60)
    assert [r["value"] for r in got.orderBy("timestamp").collect()] == [None, 5.0, None]


def test_probe_without_earlier_point(spark):
    points = spark.createDataFrame([("t", datetime(2024, 1, 2), 5.0)], "tag string, ts timestamp, value double")
    probes = spark.createDataFrame([("t", datetime(2024, 1, d)) for d in (1, 2, 3)], "tag string, ts timestamp")
    got = Ts.values_at(probes, points, "tag", "ts", "value").orderBy("ts").collect()
    assert [r["value"] for r in got] == [None, 5.0, 5.0]


@pytest.mark.parametrize("hot_rows", [100, 10000])
def test_probes_against_brute_force(spark, skewed, monkeypatch, hot_rows):
    monkeypatch.setattr(B, "HOT_ROWS", hot_rows)
    once = skewed.groupBy("tag", "ts").agg(F.max("value").alias("value"))
    probes = once.select("tag", (F.col("ts") + F.expr("INTERVAL 7 SECONDS")).alias("ts"))
    got = sorted((r["tag"], r["ts"], r["value"]) for r in Ts.values_at(probes, once, "tag", "ts", "value").collect())
    points = sorted((r["tag"], r["ts"], r["value"]) for r in once.collect())
    want = []
    for tag, at in sorted((r["tag"], r["ts"]) for r in probes.collect()):
        want.append((tag, at, [v for g, x, v in points if g == tag and x <= at][-1]))
    assert got == want


def test_pages_by_text_key(spark):
    df = spark.range(500).select(F.concat(F.lit("key-"), F.col("id") * 7919 % 500).alias("k"))
    want = sorted(r["k"] for r in df.collect())
    got = [r["k"] for n in (1, 2, 3) for r in P.page(df, ["k"], n, 200).orderBy("k").collect()]
    assert got == want


def test_deep_offset(spark, monkeypatch):
    monkeypatch.setattr(P, "SHALLOW_ROWS", 10)
    df = spark.range(300).withColumnRenamed("id", "n")
    assert sorted(r["n"] for r in P.offset_limit(df, ["n"], 120, 7).collect()) == list(range(120, 127))
    assert P.offset_limit(df, ["n"], 400, 7).count() == 0
