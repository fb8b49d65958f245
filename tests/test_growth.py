"""Steps whose work has to grow with their rows only."""

from __future__ import annotations

import json
import os
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_forest import brute_labels, brute_walk
from tidemark.operators import forest as Fo
from tidemark.operators import quality as Q
from tidemark.plans.logtable import LogTarget
from tidemark.registry import feeds, targets
from tidemark.session import SPLIT, TIDY


@pytest.mark.parametrize("land", [targets.landed, feeds.delivered])
def test_landed_files_grow_with_the_rows(spark, monkeypatch, land):
    seen = []

    def run(session, job, landing, out, scd=1):
        seen.extend(n for n in os.listdir(landing) if n.startswith("part-"))
        return session.read.text(landing)

    monkeypatch.setattr(targets.base, "run", run)
    lines = spark.range(1000, numPartitions=7).select(F.col("id").cast("string").alias("value"))
    assert land(SimpleNamespace(spark=spark), SimpleNamespace(fmt="text"), lines).count() == 1000
    assert len(seen) == 7


def no_drain(session, job, landing, out, scd=1):
    reader = session.read.option("header", "true")
    return {"text": reader.text, "csv": reader.csv, "json": reader.schema("value string").json}[job.fmt](landing)


@pytest.mark.parametrize("land, fmt", [(targets.landed, "text"), (targets.landed, "json"), (feeds.delivered, "text"), (feeds.delivered, "csv")])
def test_landed_files_are_compressed_and_bounded(spark, monkeypatch, land, fmt):
    held = []
    run = lambda session, job, landing, out, scd=1: held.append(landing) or no_drain(session, job, landing, out)
    monkeypatch.setattr(targets.base, "run", run)
    monkeypatch.setattr(targets, "LANDED_ROWS", 400)
    lines = spark.range(1000, numPartitions=1).select(F.concat(F.lit('{"channel":"general","body":'), "id", F.lit("}")).alias("value"))
    assert rows(land(SimpleNamespace(spark=spark), SimpleNamespace(fmt=fmt), lines)) == rows(lines)
    sizes = [os.path.getsize(f"{held[0]}/{n}") for n in os.listdir(held[0]) if n.startswith("part-")]
    assert len(sizes) == 3
    assert sum(sizes) < lines.select(F.sum(F.length("value"))).first()[0] / 4


@pytest.mark.parametrize("land", [targets.landed, feeds.delivered])
def test_landing_lets_its_shuffle_files_go(spark, monkeypatch, land):
    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    shuffled = lambda: {n for top in folders for _, _, names in os.walk(top) for n in names if n.startswith("shuffle_")}
    settings = {key: spark.conf.get(key, None) for key in (TIDY, SPLIT)}
    before, left = shuffled(), []

    def run(session, job, landing, out, scd=1):
        for _ in range(50):  # they go while the driver works on
            left[:] = shuffled() - before
            if not left:
                break
            time.sleep(0.1)
        return session.read.text(landing)

    monkeypatch.setattr(targets.base, "run", run)
    lines = spark.range(1000).repartition(3).select(F.col("id").cast("string").alias("value"))
    assert land(SimpleNamespace(spark=spark), SimpleNamespace(fmt="text"), lines).count() == 1000
    assert not left
    assert settings == {key: spark.conf.get(key, None) for key in settings}


def test_a_read_of_runs_shuffles_only_the_columns_that_are_read(spark, tmp_path):
    target = LogTarget(spark, str(tmp_path / "t"), ["k"], ["s"])
    for s in (1, 2):
        target.apply(spark.createDataFrame([(1, s, "long text"), (None, s, "more")], "k int, s int, v string"))
    state = target.state()
    stored = next(f.stored for f in target.fields(target.log.load()) if f.name == "v")
    plan = state.select("k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema") and f"{stored}:string" not in plan
    assert rows(state.select("k", "s", "v")) == [(1, 2, "long text"), (None, 2, "more")]


def test_nested_paths_writes_nothing(spark, monkeypatch):
    monkeypatch.setattr(Q, "saved", lambda df, name: pytest.fail(f"{name} was written"), raising=False)
    deep = 1
    for _ in range(60):
        deep = {"k": deep}
    records = [json.dumps(deep), '{"a":[{"b":1},{"b":{"c":1}},[{"d":1}],3],"e":"{"}', '[{"a":1},null]', '{"a":1,"a":2}', "{", "", None]
    found = rows(Q.nested_paths(spark.createDataFrame([(r,) for r in records], "raw string"), "raw"))
    assert found == sorted([(".".join(["k"] * n), 1) for n in range(1, 61)] + [("a", 2), ("a.b", 2), ("a.b.c", 1), ("e", 1)], key=repr)


def written_rows(monkeypatch, run):
    """Rows that ``run`` saves in all."""
    held = []
    monkeypatch.setattr(Fo, "saved", lambda df, name, keep=Fo.saved: held.append(keep(df, name)) or held[-1])
    run()
    return sum(df.count() for df in held)


def test_labels_of_a_bushy_tree_write_few_rows(spark, monkeypatch):
    frame = spark.range(400).select("id", F.when(F.col("id") > 0, F.floor((F.col("id") - 1) / 20)).alias("parent_id"))
    assert written_rows(monkeypatch, lambda: Fo.forest_labels(frame)) < 2 * 400


def test_a_leaf_takes_the_parent_that_was_settled_first(spark):
    pairs = [(1, None), (2, 3), (3, 2), (3, 5), (5, 1), (4, 2), (4, 3), (6, 2), (6, 7), (7, 1), (8, 9), (8, 3), (9, 9), (10, 9)]
    frame = spark.createDataFrame(pairs, "id int, parent_id int")
    assert rows(Fo.tree_walk(frame)) == brute_walk(pairs)
    assert rows(Fo.forest_labels(frame)) == brute_labels(pairs)


def test_totals_and_labels_of_trees_with_branches_and_chains(spark):
    pairs = [(i, None if i % 50 == 0 else i - 1 if i % 3 else i - i % 50) for i in range(300)]
    frame = spark.createDataFrame(pairs, "id int, parent_id int")
    found = brute_labels(pairs)
    labels = Fo.forest_labels(frame)
    assert rows(labels) == found
    values = spark.createDataFrame([(i, i) for i in range(300)], "id int, v long")
    inside = lambda a, b: a[2] == b[2] and a[4] <= b[4] and b[5] <= a[5]
    assert rows(Fo.subtree_totals(labels, values, "v")) == sorted([(a[0], sum(b[0] for b in found if inside(a, b))) for a in found], key=repr)


def test_paths_of_a_chain_are_not_written_in_every_round(spark, monkeypatch):
    """Text of all paths that are saved, against that of the result."""
    held = []
    monkeypatch.setattr(Fo, "saved", lambda df, name, keep=Fo.saved: held.append(keep(df, name)) or held[-1])
    pairs = [(i, i - 1 if i % 150 else None) for i in range(300)]
    walk = Fo.tree_walk(spark.createDataFrame(pairs, "id int, parent_id int"))
    assert rows(walk) == brute_walk(pairs)
    text = sum(df.select(F.sum(F.length("_tail"))).first()[0] or 0 for df in held if "_tail" in df.columns)
    assert text < walk.select(F.sum(F.length("path"))).first()[0]
