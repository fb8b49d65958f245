"""Walks and labels of forests against a plain search."""

from __future__ import annotations

import random

import pytest

from tests.conftest import rows
from tidemark.operators import forest as Fo


def edges(spark, pairs, kind="int"):
    return spark.createDataFrame(pairs, f"id {kind}, parent_id {kind}")


def brute_parents(pairs):
    """The rule, step by step: smallest parent, or the smallest that leads to a root."""
    known = {}
    for i, p in pairs:
        if i is not None:
            known.setdefault(i, set()).add(p)
    parent = {i: None if None in ps else min(ps) for i, ps in known.items()}

    def settled():
        done = {}
        for i in parent:
            seen, at = [], i
            while at in parent and parent[at] is not None and at not in seen:
                seen.append(at)
                at = parent[at]
            if at in parent and parent[at] is None:
                done[i] = True
        return done

    while True:
        done = settled()
        better = {i: min(p for p in ps if p in done) for i, ps in known.items() if i not in done and any(p in done for p in ps)}
        if not better:
            return {i: p for i, p in parent.items() if i in done}
        parent.update(better)


def brute_walk(pairs):
    parent = brute_parents(pairs)
    out = []
    for i in parent:
        path = [i]
        while parent[path[-1]] is not None:
            path.append(parent[path[-1]])
        out.append((i, parent[i], len(path) - 1, "/".join(map(str, reversed(path)))))
    return sorted(out, key=repr)


def brute_labels(pairs):
    parent = brute_parents(pairs)
    children, out = {}, []
    for i, p in parent.items():
        children.setdefault(p, []).append(i)
    for root in children.get(None, []):
        clock = 0

        def visit(i, depth):
            nonlocal clock
            enter, clock = clock, clock + 1
            below = sum(visit(c, depth + 1) for c in sorted(children.get(i, [])))
            out.append((i, parent[i], root, depth, enter, clock, below))
            clock += 1
            return below + 1

        visit(root, 0)
    return sorted(out, key=repr)


CASES = {
    "several parents": [(1, None), (2, 1), (3, 1), (4, 2), (4, 3), (5, 4), (5, 9), (6, 0), (6, 5)],
    "dense cycle": [(a, b) for a in range(4) for b in range(4) if a != b] + [(10, None), (11, 10)],
    "cycle with a way out": [(1, 2), (2, 1), (2, 7), (7, None), (3, 2), (1, 3)],
    "self and repeated": [(1, None), (1, None), (2, 2), (3, 1), (3, 1), (4, 3), (None, 1)],
    "nothing reaches a root": [(1, 2), (2, 1)],
}


@pytest.mark.parametrize("name", list(CASES))
def test_walk(spark, name):
    assert rows(Fo.tree_walk(edges(spark, CASES[name]))) == brute_walk(CASES[name])


def test_random_graphs(spark):
    for seed in range(3):
        draw = random.Random(seed)
        pairs = [(i, draw.choice([None, draw.randrange(60), draw.randrange(60)])) for i in range(50) for _ in range(draw.choice([1, 1, 2]))]
        frame = edges(spark, pairs)
        assert rows(Fo.tree_walk(frame)) == brute_walk(pairs)
        assert rows(Fo.forest_labels(frame)) == brute_labels(pairs)


def test_a_dense_cycle_ends_at_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(Fo, "saved", lambda df, name, keep=Fo.saved: written.append(name) or keep(df, name))
    ring = [(a, b) for a in range(30) for b in range(30) if a != b]
    assert Fo.tree_walk(edges(spark, ring)).collect() == []
    assert written.count("round") == 1


def test_empty_labels_and_totals(spark):
    none = edges(spark, [])
    assert Fo.tree_walk(none).collect() == [] and Fo.forest_labels(none).collect() == []
    labels = Fo.forest_labels(edges(spark, [(1, None), (2, 1), (3, 1), (4, 3), (9, None)]))
    values = spark.createDataFrame([(1, 100), (2, 10), (4, 7), (3, None), (5, 1000)], "id int, v long")
    assert rows(Fo.subtree_totals(labels, values, "v")) == [(1, 117), (2, 10), (3, 7), (4, 7), (9, 0)]
