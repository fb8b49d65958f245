"""Pyramids against the direct operators, for any range and after late points."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import pyramid as P
from tidemark.operators import timeseries as Ts

T0 = datetime(2024, 1, 1)


def points(seed, n, spread=400_000):
    draw = random.Random(seed)
    value = lambda: draw.choice([None, 0.0, 1.5, -3.0, 7.25, 100.0])
    return [(draw.choice(["a", "a", "b", None]), T0 + timedelta(seconds=draw.randrange(spread)), value(), draw.choice([True, True, None, False])) for _ in range(n)]


def test_any_range_equals_the_direct_operator(spark):
    schema = "tag string, ts timestamp, value double, good boolean"
    early, late = points(1, 150), points(2, 60) + points(1, 150)[:5] + [("new", T0 + timedelta(days=-3), 2.0, True)]
    first, more = spark.createDataFrame(early, schema), spark.createDataFrame(late, schema)
    every = spark.createDataFrame(early + late, schema).cache()
    args = ("tag", "ts", "value")
    nodes = P.build_pyramid(first, *args, 600, 3, "good")
    nodes = P.update_pyramid(nodes, every, more, *args, 600, 3, "good").cache()
    assert rows(nodes.drop("first_t")) == rows(P.build_pyramid(every, *args, 600, 3, "good").drop("first_t"))
    draw = random.Random(3)
    for weighted in (True, False, True):
        a = draw.randrange(-300_000, 400_000)
        start, end = T0 + timedelta(seconds=a), T0 + timedelta(seconds=a + draw.choice([1, 500, 700, 50_000, 900_000]))
        direct = (Ts.ts_summary_time_weighted if weighted else Ts.ts_summary)(every, *args, start, end, good="good")
        found = P.range_summary(nodes, every, *args, start, end, 600, 3, weighted, good="good")
        shown = lambda df: rows(df.withColumn("value", F.round("value", 6)))
        assert shown(found) == shown(direct), (start, end, weighted)


def test_covers():
    for first, last in ((0, 0), (-5, 300), (17, 16), (3, 5000), (-4096, 4095), (255, 257)):
        parts = P.covering(first, last, 3)
        cells = sorted(x for level, a, b in parts for x in range(a * P.FAN**level, (b + 1) * P.FAN**level))
        assert cells == list(range(first, last + 1))
    for bucket in (0, 1, 16, 255, 256, 4097, -17):
        cells = sorted(
            x for level, a, b in P.before(bucket, 3) for x in range((-(2**13) if a is None else a * P.FAN**level), (b + 1) * P.FAN**level)
        )
        assert cells == list(range(-(2**13), bucket))
    few = P.covering(1, 10**6, 5)
    assert sum(b - a + 1 for _, a, b in few) < 2 * 5 * P.FAN
