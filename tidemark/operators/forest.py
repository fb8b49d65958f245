"""Forests: every node under one parent, walked by pointer doubling, labelled by list ranking.

One row per node. A node without a parent is a root, whatever other parents it has. Else
it stands under its smallest parent, or, where that one leads to no root, under the
smallest that does. Nodes from which no way leads up to a root (on a cycle, below one,
or below a missing parent) are left out. So rows are bounded by the nodes, and a round that
settles no node ends the walk: the ancestors of a node have every smaller depth, so
what is still open then lies on cycles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans import blocks as B
from tidemark.session import saved

_OPEN = ("_id", "_parent", "_above", "_top", "_steps", "_tail")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _settle(done: list[DataFrame], open_: DataFrame, path: bool) -> list[DataFrame]:
    """Rows that reach a root, added to those that did; each round doubles the distance an open row has looked up."""
    left = open_.count()
    while left:
        up = _union([*done, open_]).select(
            F.col("_id").alias("_up"), F.col("_above").alias("_next"), F.col("_top").alias("_root"), F.col("_steps").alias("_more"),
            F.col("_tail").alias("_head"),
        )
        moved = open_.join(up, F.col("_above") == F.col("_up")).select(
            "_id", "_parent", F.col("_next").alias("_above"), F.col("_root").alias("_top"), (F.col("_steps") + F.col("_more")).alias("_steps"),
            (F.concat_ws("/", "_head", "_tail") if path else F.col("_tail")).alias("_tail"),
        )
        table = saved(moved, "round")
        fresh, open_ = table.where(F.col("_above").isNull()), table.where(F.col("_above").isNotNull())
        still = open_.count()
        if still == left:
            break
        done, left = [*done, fresh], still
    return done


def _parents(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """One row per node: its smallest parent (null: a root), whether it has several, whether it is a parent itself."""
    edges = nodes.select(F.col(node).alias("_id"), F.col(parent).alias("_parent")).where(F.col("_id").isNotNull())
    below = edges.where(F.col("_parent").isNotNull()).select(F.col("_parent").alias("_id"), F.lit(None).cast(edges.schema["_parent"].dataType).alias("_parent"))
    marked = edges.withColumn("_own", F.lit(True)).union(below.withColumn("_own", F.lit(False)))
    once = marked.groupBy("_id").agg(
        F.bool_or(F.col("_own") & F.col("_parent").isNull()).alias("_root"), F.min("_parent").alias("_least"), F.max("_parent").alias("_most"),
        F.bool_or(~F.col("_own")).alias("_inner"), F.bool_or("_own").alias("_own"),
    )
    return once.where("_own").select(
        F.col("_id").cast(edges.schema["_id"].dataType).alias("_id"), F.when(~F.col("_root"), F.col("_least")).alias("_parent"), (~F.col("_root") & (F.col("_least") != F.col("_most"))).alias("_several"), "_inner"
    )


def _inner_and_leaves(nodes: DataFrame, node: str, parent: str, walk: bool = True) -> tuple[DataFrame, DataFrame]:
    """Settled rows of the nodes that are parents, and the leaves with the parent each stands under (or none).

    Leaves have no part in the walk. A leaf's parent may still be one that no root reaches.
    Without ``walk`` that holds for inner nodes too, unless several parents have to be tried.
    """
    once = saved(_parents(nodes, node, parent), "parents")
    inner, leaves = once.where("_inner"), once.where("not _inner")

    def begun(rows: DataFrame) -> DataFrame:
        top = F.when(F.col("_parent").isNull(), F.col("_id"))
        steps = F.col("_parent").isNotNull().cast("long")
        none = F.lit(None).cast("string")
        return rows.select("_id", "_parent", F.col("_parent").alias("_above"), top.alias("_top"), steps.alias("_steps"), none.alias("_tail"))

    first, several = begun(inner), once.where("_several")
    alone = several.isEmpty()
    if alone and not walk:
        return first, leaves.select("_id", "_parent")
    done = _settle([first.where(F.col("_above").isNull())], first.where(F.col("_above").isNotNull()), path=False)
    if alone:
        return _union(done), leaves.select("_id", "_parent")
    edges = nodes.select(F.col(node).alias("_id"), F.col(parent).alias("_parent")).join(several.select("_id", "_inner"), "_id").distinct()
    edges, rounds = saved(edges, "edges"), [len(done)]
    while True:
        # nodes whose parent leads nowhere, but another one does
        known = _union([d.select("_id") for d in done])
        missed = saved(inner.select("_id", "_parent").join(known, "_id", "left_anti"), "missed")
        ways = edges.join(missed.select("_id"), "_id", "left_semi").join(known.select(F.col("_id").alias("_parent")), "_parent", "left_semi")
        better = saved(ways.groupBy("_id").agg(F.min("_parent").alias("_better")), "better")
        if better.isEmpty():
            break
        again = missed.join(better, "_id", "left").select("_id", F.coalesce("_better", "_parent").alias("_parent"))
        done = _settle(done, saved(begun(again), "again"), path=False)
        rounds.append(len(done))
    # a leaf takes the smallest of its parents that were settled first
    turn = [sum(i >= r for r in rounds) for i in range(len(done))]
    when = _union([d.select(F.col("_id").alias("_parent"), F.lit(n).alias("_turn")) for d, n in zip(done, turn, strict=True)])
    best = edges.where("not _inner").join(when, "_parent").groupBy("_id").agg(F.min(F.struct("_turn", "_parent")).alias("_best"))
    rest = leaves.where("not _several").select("_id", "_parent")
    return _union(done), rest.unionByName(best.select("_id", F.col("_best._parent").alias("_parent")))


def _stop(c: Column) -> Column:
    """Whether a node is one where walks stop: about one in eight, told by its id alone."""
    return F.pmod(F.xxhash64(c.cast("string")), F.lit(8)) == 0


def _short_walks(inner: DataFrame) -> DataFrame:
    """For each inner node the nearest stop above it (``_above``, null past a root), the steps to it and the path below it.

    Each round doubles the distance an open row has looked up. Paths stay short: most walks end after a few nodes.
    """
    text, steps = F.col("_id").cast("string"), F.col("_parent").isNotNull().cast("long")
    first = inner.select("_id", "_parent", F.col("_parent").alias("_above"), steps.alias("_steps"), text.alias("_tail"))
    ended = F.col("_above").isNull() | _stop(F.col("_above"))
    done, open_ = [first.where(ended)], first.where(~ended)
    left = open_.count()
    while left:
        up = _union([*done, open_]).where(~_stop(F.col("_id"))).select(
            F.col("_id").alias("_up"), F.col("_above").alias("_next"), F.col("_steps").alias("_more"), F.col("_tail").alias("_head")
        )
        moved = open_.join(up, F.col("_above") == F.col("_up")).select(
            "_id", "_parent", F.col("_next").alias("_above"), (F.col("_steps") + F.col("_more")).alias("_steps"), F.concat_ws("/", "_head", "_tail").alias("_tail")
        )
        table = saved(moved, "round")
        fresh, open_ = table.where(ended), table.where(~ended)
        still = open_.count()
        if still == left:
            break
        done, left = [*done, fresh], still
    return _union(done)


def tree_walk(nodes: DataFrame, node: str = "id", parent: str = "parent_id") -> DataFrame:
    """Depth and path of every node that a root (a node without parent) reaches, one row each; see the rule above.

    A forest of depth ``d`` takes about ``log2(d)`` rounds of one join, whatever its shape. Nodes
    walk up to the nearest stop only; whole paths are made for the stops, and put before
    the short ones at last. So long paths are not moved in every round.
    """
    inner, leaves = _inner_and_leaves(nodes, node, parent, walk=False)
    short = _short_walks(inner.select("_id", "_parent"))
    text, one = F.col("_id").cast("string").alias("_tail"), F.lit(1).cast("long").alias("_steps")
    below = F.col("_parent").isNotNull()
    up = short.where(~_stop(F.col("_id"))).select(
        F.col("_id").alias("_up"), "_above", (F.col("_steps") + 1).alias("_steps"), F.concat(F.col("_tail"), F.lit("/")).alias("_head")
    )
    under = leaves.where(below & ~_stop(F.col("_parent"))).join(up, F.col("_parent") == F.col("_up")).select(
        "_id", "_parent", "_above", "_steps", F.concat("_head", F.col("_id").cast("string")).alias("_tail")
    )
    at_stop = leaves.where(below & _stop(F.col("_parent"))).select("_id", "_parent", F.col("_parent").alias("_above"), one, text)
    alone = leaves.where(~below).select("_id", "_parent", F.col("_parent").alias("_above"), F.lit(0).cast("long").alias("_steps"), text)
    stops = saved(short.where(_stop(F.col("_id"))).withColumn("_top", F.col("_id")), "stops")
    whole = _union(_settle([stops.where(F.col("_above").isNull())], stops.where(F.col("_above").isNotNull()), path=True))
    whole = whole.select(F.col("_id").alias("_up"), F.col("_steps").alias("_more"), F.concat(F.col("_tail"), F.lit("/")).alias("_head"))
    rows = _union([short, under, at_stop, alone])
    ends = rows.where(F.col("_above").isNull()).select("_id", "_parent", "_steps", "_tail")
    far = rows.join(whole, F.col("_above") == F.col("_up")).select(
        "_id", "_parent", (F.col("_steps") + F.col("_more")).alias("_steps"), F.concat("_head", "_tail").alias("_tail")
    )
    return ends.unionByName(far).select(
        F.col("_id").alias(node), F.col("_parent").alias(parent), F.col("_steps").cast("int").alias("depth"), F.col("_tail").alias("path")
    )


def _toured(tree: DataFrame) -> DataFrame:
    """Subtree weights ``_size`` of a forest of any shape (_id, _parent, _own).

    The tour of a tree goes down to and up from every node. It is a linked list of two arcs
    per node, ranked by pointer doubling: each round is one join of the open arcs on the arc
    they point to, which is unique.
    """
    held = tree.where(F.col("_parent").isNotNull()).select("_id", "_parent")
    beside = B.neighbours(held, ["_parent"], ["_id"], lambda w: {"_next": F.lead("_id").over(w)}, before=False)
    first = saved(held.groupBy(F.col("_parent").alias("_id")).agg(F.min("_id").alias("_first")), "first")
    linked = tree.join(beside.select("_id", "_next"), "_id", "left").join(first, "_id", "left")
    arc = lambda c, up: F.struct(c.alias("id"), F.lit(up).alias("up"))
    down = F.when(F.col("_first").isNotNull(), arc(F.col("_first"), False)).otherwise(arc(F.col("_id"), True))
    up = F.when(F.col("_next").isNotNull(), arc(F.col("_next"), False)).when(F.col("_parent").isNotNull(), arc(F.col("_parent"), True))
    pair = F.array(
        F.struct(arc(F.col("_id"), False).alias("arc"), down.alias("to"), F.col("_own").alias("far")),
        F.struct(arc(F.col("_id"), True).alias("arc"), up.alias("to"), F.lit(0).cast("long").alias("far")),
    )
    arcs = saved(linked.select(F.explode(pair).alias("p")).select("p.*"), "arcs")
    done, open_ = [arcs.where(F.col("to").isNull())], arcs.where(F.col("to").isNotNull())
    while not open_.isEmpty():
        ahead = _union([*done, open_]).select(F.col("arc").alias("_arc"), F.col("to").alias("_to"), F.col("far").alias("_far"))
        moved = open_.join(ahead, F.col("to") == F.col("_arc")).select("arc", F.col("_to").alias("to"), (F.col("far") + F.col("_far")).alias("far"))
        table = saved(moved, "ranks")
        done, open_ = [*done, table.where(F.col("to").isNull())], table.where(F.col("to").isNotNull())
    return _union(done).groupBy(F.col("arc.id").alias("_id")).agg(
        (F.max(F.when(~F.col("arc.up"), F.col("far"))) - F.max(F.when(F.col("arc.up"), F.col("far")))).alias("_size")
    )


def _sizes(tree: DataFrame) -> DataFrame:
    """Subtree weights ``_size`` of a forest (_id, _parent, _own).

    Leaves are taken off and added to their parents as long as that at least halves the
    nodes; the tour is taken of what is left, so a bushy forest costs a few times its rows.
    """
    sized, rest, count = [], tree, tree.count()
    while count:
        inner = saved(rest.where(F.col("_parent").isNotNull()).groupBy("_parent").count().select(F.col("_parent").alias("_id")), "inner")
        left = inner.count()
        if 2 * left > count:
            return _union([*sized, _toured(rest)])
        tips = rest.join(inner, "_id", "left_anti")
        below = tips.where(F.col("_parent").isNotNull()).groupBy(F.col("_parent").alias("_id")).agg(F.sum("_own").alias("_more"))
        sized.append(tips.select("_id", F.col("_own").alias("_size")))
        whole = rest.join(inner, "_id", "left_semi").join(below, "_id", "left")
        rest, count = saved(whole.select("_id", "_parent", (F.col("_own") + F.coalesce("_more", F.lit(0))).alias("_own")), "rest"), left
    return _union(sized) if sized else tree.select("_id", F.col("_own").alias("_size"))


def forest_labels(nodes: DataFrame, node: str = "id", parent: str = "parent_id") -> DataFrame:
    """Enter and leave numbers: a node's subtree are the nodes of its root with ``enter`` within its own numbers.

    The tour of a tree goes down to and up from every node, children in the order of their
    ids. A node's place in it follows from the subtrees of its ancestors' and its own earlier
    siblings: one running total over all siblings, added up along the inner nodes.
    """
    inner, leaves = _inner_and_leaves(nodes, node, parent)
    inner = saved(inner.select("_id", "_parent", "_top", F.col("_steps").alias("_depth")), "inner")
    below = leaves.where(F.col("_parent").isNotNull()).groupBy(F.col("_parent").alias("_id")).agg(F.count("*").alias("_n"))
    weighed = inner.join(below, "_id", "left").select("_id", "_parent", (1 + F.coalesce("_n", F.lit(0))).cast("long").alias("_own"))
    tree = saved(inner.join(_sizes(saved(weighed, "weighed")), "_id"), "tree")
    one = F.lit(1).cast("long").alias("_size")
    kids = tree.select("_id", "_parent", "_size", F.lit(True).alias("_inner")).unionByName(leaves.select("_id", "_parent", one, F.lit(False).alias("_inner")))
    kids = kids.where(F.col("_parent").isNotNull())
    placed = lambda rows: B.running_position(rows, ["_id"], "_upto", F.col("_size"), ["_parent"]).select("*", (F.col("_upto") - F.col("_size") + 1).alias("_ahead"))
    mixed = saved(tree.where(F.col("_parent").isNotNull()).select("_parent").distinct(), "mixed")
    steps = placed(kids.join(mixed, "_parent", "left_semi")).where("_inner").select("_id", F.col("_ahead"))
    walk = tree.join(steps, "_id", "left").select(
        "_id", "_parent", F.col("_parent").alias("_above"), F.when(F.col("_parent").isNull(), F.col("_id")).alias("_top"),
        F.coalesce("_ahead", F.lit(0)).cast("long").alias("_steps"), F.lit(None).cast("string").alias("_tail"),
    )
    walk = saved(walk, "walk")
    done = _union(_settle([walk.where(F.col("_above").isNull())], walk.where(F.col("_above").isNotNull()), path=False))
    tree = saved(tree.join(done.select("_id", F.col("_steps").alias("_before")), "_id"), "placed")
    up = tree.select(F.col("_id").alias("_up"), "_top", (F.col("_depth") + 1).alias("_depth"), F.col("_before").alias("_above"))
    # for leaves alone the siblings have to be counted again, where an inner one stands between them
    under = placed(kids).where("not _inner").join(up, F.col("_parent") == F.col("_up")).select(
        "_id", "_parent", "_top", "_depth", "_size", (F.col("_above") + F.col("_ahead")).alias("_before")
    )
    alone = leaves.where(F.col("_parent").isNull()).select(
        "_id", "_parent", F.col("_id").alias("_top"), F.lit(0).cast("long").alias("_depth"), one, F.lit(0).cast("long").alias("_before")
    )
    every = _union([tree.select("_id", "_parent", "_top", "_depth", "_size", "_before"), under, alone])
    enter = 2 * F.col("_before") - F.col("_depth")
    return every.select(
        F.col("_id").alias(node), F.col("_parent").alias(parent), F.col("_top").alias("root"), F.col("_depth").cast("int").alias("depth"),
        enter.alias("enter"), (enter + 2 * F.col("_size") - 1).alias("leave"), (F.col("_size") - 1).alias("descendants"),
    )


def subtree_totals(labels: DataFrame, values: DataFrame, value: str, node: str = "id") -> DataFrame:
    """Sum of ``value`` over each node's subtree, itself included: one running total per tree, read at two places.

    ``values`` has at most one row per node; a node without one, or a null, counts nothing.
    Decimals and integers stay exact.
    """
    held = saved(
        labels.join(values.select(F.col(node).alias("_node"), F.col(value).alias("_value")), F.col(node) == F.col("_node"), "left").select(
            F.col(node).alias("_id"), "root", F.expr("(enter + depth) div 2").alias("place"), "descendants", F.coalesce("_value", F.lit(0)).alias("_value")
        ),
        "held",
    )
    sums = saved(B.running_position(held, ["place"], "total", F.col("_value"), ["root"]), "sums")
    last = sums.select(F.col("root").alias("_root"), F.col("place").alias("_place"), F.col("total").alias("_until"))
    met = sums.join(last, (F.col("root") == F.col("_root")) & (F.col("place") + F.col("descendants") == F.col("_place")))
    return met.select(F.col("_id").alias(node), (F.col("_until") - F.col("total") + F.col("_value")).alias("subtree_total"))
