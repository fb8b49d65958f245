"""Change apply: order, replay, deletes, ties."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.plans import apply as A
from tidemark.plans import blocks as B
from tidemark.plans.target import AppendTarget, Target

T0 = datetime(2024, 1, 1)
SCHEMA = "order_id string, amount double, updated_at timestamp, _deleted boolean"


def at(hours):
    return T0 + timedelta(hours=hours)


CHANGES = [
    ("a", 1.0, at(1), False),
    ("a", 2.0, at(3), False),
    ("a", 2.0, at(4), False),  # unchanged payload
    ("a", None, at(5), True),
    ("a", 1.5, at(2), False),  # late, older than the delete
    ("a", 9.0, at(7), False),  # comes back
    ("b", None, at(2), True),  # deleted before it was seen
    ("b", 3.0, at(1), False),
    ("c", None, at(1), False),  # null amount is a value
    ("c", 4.0, at(2), False),
    ("c", 4.0, at(2), False),  # delivered twice
    ("d", 5.0, at(3), False),
    ("d", None, at(3), True),  # delete wins at equal sequence
]


def brute_scd2(changes):
    """Versions by a plain walk over each key."""
    out = []
    for key in sorted({c[0] for c in changes}):
        by_seq = {}
        for _, amount, seq, gone in changes:
            if _ != key:
                continue
            if seq not in by_seq or gone:
                by_seq[seq] = (amount, gone)
        live = None
        for seq in sorted(by_seq):
            amount, gone = by_seq[seq]
            if gone:
                if live:
                    out.append((key, live[0], live[1], seq))
                live = None
            elif live is None or live[0] != amount:
                if live:
                    out.append((key, live[0], live[1], seq))
                live = (amount, seq)
        if live:
            out.append((key, live[0], live[1], None))
    return sorted(out, key=repr)


def history(state):
    return rows(A.history_rows(state).select("order_id", "amount", "valid_from", "valid_to"))


@pytest.mark.parametrize("seed", range(4))
def test_scd2_any_order_any_batches(spark, seed):
    shuffled = CHANGES[:]
    random.Random(seed).shuffle(shuffled)
    cut = 1 + seed * 3
    first, second = shuffled[:cut], shuffled[cut:]
    state = A.scd2_state(spark.createDataFrame(first, SCHEMA), ["order_id"], ["updated_at"])
    batch = spark.createDataFrame(second, SCHEMA)
    state = A.apply_changes_scd2(state, batch, ["order_id"], ["updated_at"])
    assert history(state) == brute_scd2(CHANGES)
    # the same batch again changes nothing
    assert history(A.apply_changes_scd2(state, batch, ["order_id"], ["updated_at"])) == brute_scd2(CHANGES)


def brute_scd1(changes):
    best = {}
    for key, amount, seq, gone in changes:
        rank = (seq, gone)
        if key not in best or rank > best[key][0]:
            best[key] = (rank, amount)
    return sorted(((k, a) for k, (r, a) in best.items() if not r[1]), key=repr)


@pytest.mark.parametrize("merge", ["shuffle", "probe"])
@pytest.mark.parametrize("seed", range(3))
def test_scd1_any_order(spark, seed, merge):
    shuffled = CHANGES[:]
    random.Random(10 + seed).shuffle(shuffled)
    cut = 2 + seed * 4
    state = A.winners(spark.createDataFrame(shuffled[:cut], SCHEMA), ["order_id"], ["updated_at"])
    for _ in range(2):
        state = A.apply_changes_scd1(
            state, spark.createDataFrame(shuffled[cut:], SCHEMA), ["order_id"], ["updated_at"], merge
        )
    assert rows(A.current_rows(state).select("order_id", "amount")) == brute_scd1(CHANGES)


def test_equal_sequence_is_settled_by_payload(spark):
    two = [("x", 1.0, at(1), False), ("x", 2.0, at(1), False)]
    one = A.winners(spark.createDataFrame(two, SCHEMA), ["order_id"], ["updated_at"])
    other = A.winners(spark.createDataFrame(two[::-1], SCHEMA), ["order_id"], ["updated_at"])
    assert rows(one) == rows(other)


def test_scd2_hot_key(spark):
    """A third of all versions on one key, cut into many blocks."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("order_id"),
        (F.col("id") % 7).cast("double").alias("amount"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("updated_at"),
        (F.col("id") % 11 == 0).alias("_deleted"),
    )
    split = B.find_split(df, ["order_id"], "updated_at", blocks=64, hot_rows=500)
    assert len(split.hot) == 1 and len(split.cuts) == 63
    got = A.scd2_state(df, ["order_id"], ["updated_at"], split)
    plain = [tuple(r) for r in df.collect()]
    assert history(got) == brute_scd2(plain)


def test_snapshot_versions(spark):
    schema = "id int, v string"
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], schema)
    hist = first.withColumn("valid_from", F.lit(T0)).withColumn("valid_to", F.lit(None).cast("timestamp"))
    second = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], schema)
    hist = A.apply_snapshot(hist, second, ["id"], at(1), scd=2)
    third = spark.createDataFrame([(1, "a"), (3, None), (4, "d")], schema)
    hist = A.apply_snapshot(hist, third, ["id"], at(2), scd=2)
    assert rows(hist) == sorted(
        [
            (1, "a", T0, None),
            (2, "b", T0, at(1)),
            (2, "B", at(1), at(2)),
            (3, None, T0, at(1)),
            (3, None, at(2), None),
            (4, "d", at(1), None),
        ],
        key=repr,
    )


def test_target_skips_a_repeated_batch(spark, tmp_path):
    target = Target(spark, str(tmp_path / "t"), ["id"])
    df = spark.createDataFrame([(2, "b"), (1, "a")], "id int, v string")
    assert target.apply("f", 0, lambda state: df)
    assert not target.apply("f", 0, lambda state: df.where("false"))
    assert target.apply("g", 0, lambda state: state.where("id = 1"))
    assert rows(target.state()) == [(1, "a")]
    assert (target.head().generation, target.head().flows) == (2, {"f": ["", 0], "g": ["", 0]})


def test_target_rewrites_touched_buckets_only(spark, tmp_path):
    target = Target(spark, str(tmp_path / "t"), keys=["id"], buckets=8, keep=2)
    many = spark.range(200).select("id", F.lit("a").alias("v"), F.lit(1).alias("s"))
    step = lambda rows: lambda state: A.winners(A.as_changes(rows), ["id"], ["s"]) if state is None else A.apply_changes_scd1(state, rows, ["id"], ["s"])
    assert target.apply("f", 0, step(many), many, "q1")
    before = dict(target.head().parts)
    one = spark.createDataFrame([(7, "b", 2)], "id long, v string, s int")
    assert target.apply("f", 1, step(one), one, "q1")
    after = target.head().parts
    assert sum(before[b] != after[b] for b in before) == 1
    assert not target.apply("f", 1, step(one), one, "q1")
    assert target.apply("f", 0, step(one), one, "q2")  # another checkpoint counts from 0 again
    state = A.current_rows(target.state())
    assert state.count() == 200 and rows(state.where("id = 7")) == [(7, "b", 2)]
    for k in range(3):
        target.apply("g", k, step(one), one)
    assert len(list((tmp_path / "t" / "commits").iterdir())) == 2
    assert A.current_rows(target.state()).count() == 200


def test_append_refuses_an_unknown_query(spark, tmp_path):
    target = AppendTarget(spark, str(tmp_path / "t"))
    df = spark.range(3)
    target.append(df, "f", 0, "q1")
    target.append(df, "f", 0, "q1")
    assert target.read().count() == 3
    with pytest.raises(ValueError, match="another query"):
        target.append(df, "f", 0, "q2")


@pytest.mark.parametrize("merge", ["shuffle", "probe"])
def test_null_keys_are_replayed_once(spark, merge):
    batch = spark.createDataFrame([(None, 1, "a"), (1, 1, "b")], "id int, s int, v string")
    state = A.winners(A.as_changes(batch), ["id"], ["s"])
    for _ in range(2):
        state = A.apply_changes_scd1(state, batch, ["id"], ["s"], merge)
    assert rows(A.current_rows(state)) == [(1, 1, "b"), (None, 1, "a")]
    history = A.scd2_state(batch, ["id"], ["s"])
    for _ in range(2):
        history = A.apply_changes_scd2(history, batch, ["id"], ["s"])
    assert A.history_rows(history).count() == 2


def test_both_merges_agree_and_no_other_is_known(spark):
    old = A.winners(A.as_changes(spark.createDataFrame([(1, 1, "a"), (None, 1, "n"), (2, 5, "b")], "k int, s int, v string")), ["k"], ["s"])
    new = spark.createDataFrame([(1, 2, "A", False), (None, 2, None, True), (2, 4, "late", False), (3, 1, "c", False)], "k int, s int, v string, _deleted boolean")
    expected = sorted([(1, 2, "A", False), (None, 2, None, True), (2, 5, "b", False), (3, 1, "c", False)], key=repr)
    for merge in ("shuffle", "probe"):
        assert rows(A.apply_changes_scd1(old, new, ["k"], ["s"], merge).select("k", "s", "v", "_deleted")) == expected
    with pytest.raises(ValueError, match="auto"):
        A.apply_changes_scd1(old, new, ["k"], ["s"], "auto")


def test_merge_shuffles_each_side_once(spark):
    frame = spark.range(100).select("id", F.lit(1).alias("s"), F.lit("x").alias("v"))
    plan = A.apply_changes_scd1(frame, frame, ["id"], ["s"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_a_column_that_changes_its_type_rewrites_the_target(spark, tmp_path):
    target = Target(spark, str(tmp_path / "t"), keys=["id"], buckets=4)
    target.apply("f", 0, lambda state: spark.range(20).select("id", F.lit(1).alias("v")))
    text = spark.createDataFrame([(3, "x")], "id long, v string")
    merge = lambda state: state.where("id <> 3").withColumn("v", F.col("v").cast("string")).unionByName(text)
    target.apply("f", 1, merge, text)
    assert rows(target.state()) == sorted([(i, "x" if i == 3 else "1") for i in range(20)], key=repr)
