"""Rules on nulls, ties and odd inputs that hold across operators."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import aggregate as Ag
from tidemark.operators import incremental as I
from tidemark.operators import joins as J
from tidemark.operators import paging as P
from tidemark.operators import quality as Q
from tidemark.operators import timeseries as Ts
from tidemark.plans import ingest as In
from tidemark.sources import base
from tidemark.sources import documents as D
from tidemark.sources import records as Rc


def test_a_null_tie_fails_and_null_cursors_are_counted(spark):
    df = spark.createDataFrame([(1, 10), (2, None), (None, 30)], "c int, t int")
    with pytest.raises(PySparkException, match="tie-break column t"):
        P.keyset_page(df, "c", "t", None, None, 10).collect()
    with pytest.raises(PySparkException, match="tie-break column t"):
        P.keyset_page(df, "c", "t", 1, 10, 10).collect()
    good = df.where("t is not null")
    assert rows(P.keyset_page(good, "c", "t", None, None, 10)) == [(1, 10)]
    assert rows(P.uncursored(df, "c")) == [(1,)]


def test_tree_walk_leaves_cycles_and_orphans_out(spark):
    nodes = spark.createDataFrame(
        [("a", None), ("b", "a"), ("c", "b"), ("x", "y"), ("y", "x"), ("z", "y"), ("o", "gone"), ("s", "s"), (None, "a")], "id string, parent_id string"
    )
    assert rows(J.tree_walk(nodes)) == [("a", None, 0, "a"), ("b", "a", 1, "a/b"), ("c", "b", 2, "a/b/c")]
    assert J.tree_walk(nodes.limit(0)).collect() == []


def test_ties_do_not_depend_on_row_order(spark):
    schema = "k string, ts int, v string"
    data = [("a", 1, "x"), ("a", 1, "y"), ("a", 1, None), ("b", 2, "p"), ("b", 2, "q")]
    there, back = (spark.createDataFrame(d, schema).repartition(n) for d, n in ((data, 1), (data[::-1], 3)))
    for pick in (
        lambda df: Ag.latest_per_key(df, ["k"], ["ts"]), lambda df: Ts.end_value(df, "k", "ts"), lambda df: I.dedupe_points(df, "k", "ts"),
        lambda df: J.latest_at(df, ["k"], "ts", 5),
    ):
        assert rows(pick(there)) == rows(pick(back)) and len(rows(pick(there))) == 2


def test_windows_that_overlap(spark):
    check = lambda *w: tuple(Q.check_partitions(spark.createDataFrame(list(w), "since int, until int")).first())
    assert check((1, 10), (3, 5)) == (1, 0, 1, 10, 0)
    assert check((1, 5), (3, 8)) == (1, 0, 1, 8, 0)
    assert check((1, 5), (1, 5), (5, 6)) == (1, 0, 1, 6, 0)
    assert check((1, 5), (6, 7), (9, 9)) == (0, 1, 1, 7, 1)


def test_ambiguous_metadata_fails(spark):
    frame = spark.createDataFrame([("t", ["a"]), ("t", ["b"]), ("u", ["c"])], "tableName string, primary_keys array<string>")
    with pytest.raises(ValueError, match="'t'"):
        In._metadata(frame, ["t", "u"])
    assert In._metadata(frame, ["u"])["u"]["primary_keys"] == ["c"]


def test_bad_lines_are_counted(spark):
    lines = spark.createDataFrame([('{"event":"e","properties":{}}',), ("{broken",), ("",)], "value string")
    assert rows(D.bad_lines(lines)) == [(1,)] and D.analytics_events(lines).count() == 1


def test_job_without_tombstones_folder(spark, tmp_path):
    job = next(j for j in Rc.example_jobs() if j.name == "orders")
    spark.range(3).select(F.col("id").cast("string").alias("order_id"), F.lit("2024-01-01T00:00:00Z").alias("updated_at")).write.json(str(tmp_path / "in"))
    assert base.run(spark, job, str(tmp_path / "in"), str(tmp_path / "out")).count() == 3


def test_null_keys_in_snapshots(spark):
    old = spark.createDataFrame([(None, "a"), (1, "b"), (2, "c")], "id int, v string")
    new = spark.createDataFrame([(None, "a"), (1, "B")], "id int, v string")
    assert rows(J.snapshot_anti(old, new, ["id"])) == [(2, "c")]
