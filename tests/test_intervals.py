"""Interval pairs and kept user bitmaps against plain sets."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import aggregate as Ag
from tidemark.operators import intervals as In
from tidemark.operators import user_days as Ud


def test_cover_is_the_interval(spark):
    draw = random.Random(1)
    spans = [(s, s + draw.choice([0, 1, 7, 8, 63, 64, 500])) for s in (draw.randrange(600) for _ in range(60))]
    found = spark.createDataFrame(spans, "s long, e long").select("s", "e", In.cover(F.col("s"), F.col("e"), 3).alias("c")).collect()
    for r in found:
        slots = [x for q in r["c"] for x in range(q["slot"] * In.FAN ** q["level"], (q["slot"] + 1) * In.FAN ** q["level"])]
        assert sorted(slots) == list(range(r["s"], r["e"] + 1))
        assert len(r["c"]) <= 2 * (In.FAN - 1) * 3 + In.FAN


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs(spark, seed):
    draw = random.Random(seed)

    def spans(n):
        out = [(draw.choice([1, 2, None]), draw.choice([None, *range(-100, 1000)]), draw.choice([0, 0, 2, 30, 400, -5])) for _ in range(n)]
        return [(i, g, s, None if s is None or draw.random() < 0.1 else s + d) for i, (g, s, d) in enumerate(out)]

    a, b = [*spans(60), (60, 1, -5000, 5000)], spans(60)
    schema = "i int, g int, start_time long, end_time long"
    far = 10**9
    meet = lambda x, y: (
        None not in (x[2], y[2]) and x[2] <= (far if x[3] is None else x[3]) and y[2] <= (far if y[3] is None else y[3])
        and x[2] <= (far if y[3] is None else y[3]) and y[2] <= (far if x[3] is None else x[3])
    )
    left, right = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    ids = lambda p: rows(p.select(F.col("left.i").alias("a"), F.col("right.i").alias("b")))
    assert ids(In.overlapping_pairs(left, right)) == sorted(((x[0], y[0]) for x in a for y in b if meet(x, y)), key=repr)
    assert ids(In.overlapping_pairs(left, right, by=["g"])) == sorted(((x[0], y[0]) for x in a for y in b if meet(x, y) and x[1] == y[1]), key=repr)
    assert ids(In.overlapping_pairs(left.limit(0), right)) == []
    assert ids(In.overlapping_pairs(left.limit(0), right.limit(0))) == []


def test_users_of_any_range(spark):
    draw = random.Random(3)
    data = [(draw.choice([None, *"abcdefghij"]), datetime(2024, 1, 1) + timedelta(hours=draw.randrange(900)), draw.choice("xy")) for _ in range(300)]
    frames = [spark.createDataFrame(d, "who string, ts timestamp, kind string") for d in (data[:200], data[200:], [])]
    users, kept = None, None
    for frame in frames:
        users = Ud.number_users(frame, "who", users)
        made = Ud.day_bitmaps(frame, users, "who", "ts", ["kind"])
        kept = made if kept is None else Ud.add_days(kept, made)
    kept = Ud.add_days(kept, Ud.day_bitmaps(frames[0], users, "who", "ts", ["kind"]))  # delivered again
    assert sorted(r["number"] for r in users.collect()) == list(range(1, 11))
    there = lambda lo, hi, kind=None: {w for w, t, k in data if w and lo <= t.date() <= hi and kind in (None, k)}
    lo, hi = date(2024, 1, 4), date(2024, 1, 9)
    assert rows(Ud.users_between(kept, lo, hi)) == [(len(there(lo, hi)),)]
    assert rows(Ud.users_between(kept, lo, hi, ["kind"])) == [(k, len(there(lo, hi, k))) for k in "xy"]
    days = sorted({t.date() for w, t, _ in data if w})
    assert rows(Ud.rolling_users(kept, 5)) == sorted(((d, len(there(d - timedelta(days=4), d))) for d in days), key=repr)


@pytest.mark.parametrize("bins", [1, 3, 8])
def test_bins_stay_within_their_bound(spark, bins):
    draw = random.Random(bins)
    for weights in ([draw.choice([1, 1, 2, 5, 40]) for _ in range(80)], [100, 1, 1, 1], [0, 0, None, -1], [7.5], [draw.random() for _ in range(50)], []):
        frame = spark.createDataFrame([(i, None if w is None else float(w), "x") for i, w in enumerate(weights)], "id int, w double, bin_name string")
        found = Ag.pour_bins(frame, "id", "w", bins).collect()
        assert sorted(r["id"] for r in found) == list(range(len(weights))) and all(0 <= r["bin"] < bins for r in found)
        loads = [sum(max(r["w"] or 0, 0) for r in found if r["bin"] == b) for b in range(bins)]
        heaviest = max([max(w or 0, 0) for w in weights], default=0)
        assert max(loads) <= sum(loads) / bins * 4 / 3 + heaviest + 1e-9
        if heaviest * 3 * bins <= sum(loads):
            assert max(loads) <= sum(loads) / bins * 4 / 3 + 1e-9
