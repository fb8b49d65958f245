"""Pyramids of series summaries: any range from a few nodes, late points update a few nodes.

A node sums up the points of a tag in one bucket: counts and sums of the points, and the
integral of the held value from its first to its last point. Two neighbouring nodes merge
exactly: the value held at the end of one lasts until the first point of the next. Level
``n`` has buckets ``FAN ** n`` times as wide as the finest. A range is covered by a
logarithmic number of nodes, and only the finest buckets it cuts are read as points.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import timeseries as Ts
from tidemark.plans import blocks as B
from tidemark.session import saved

#: Buckets of a level that make one of the next.
FAN = 16


def _gap(ahead: str = "_ahead") -> tuple[Column, Column]:
    """Integrals of the value, and of its square, that a piece holds until the next one starts."""
    dt = (F.col(ahead) - F.col("last_t")).cast("double")
    held = F.coalesce(F.col("last_v") * dt, F.lit(0.0))
    return held, F.coalesce(F.col("last_v") * F.col("last_v") * dt, F.lit(0.0))


def _merged(pieces: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pieces of a key, each with the start of the next one as ``_ahead``, as one."""
    wv, wvv = _gap()
    return pieces.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("points", "total", "squares", "stretches")],
        F.sum(F.col("wv") + wv).alias("wv"), F.sum(F.col("wvv") + wvv).alias("wvv"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("first_t").alias("first_t"), F.max("last_t").alias("last_t"), F.max_by("last_v", "last_t").alias("last_v"),
    )


def _as_pieces(points: DataFrame) -> DataFrame:
    """A piece per tag and time of ``tag, t, v``; at one time the largest value is held."""
    v = F.col("v")
    return points.groupBy("tag", "t").agg(
        F.count("*").alias("points"), F.sum(v).alias("total"), F.sum(v * v).alias("squares"), F.lit(1).cast("long").alias("stretches"),
        F.lit(0.0).alias("wv"), F.lit(0.0).alias("wvv"), F.min(v).alias("low"), F.max(v).alias("high"), F.max(v).alias("last_v"),
    ).withColumns({"first_t": F.col("t"), "last_t": F.col("t")}).drop("t")


def _level(pieces: DataFrame, bucket: Column, level: int) -> DataFrame:
    within = Window.partitionBy("tag", "bucket").orderBy("first_t")
    placed = pieces.withColumn("bucket", bucket).withColumn("_ahead", F.lead("first_t").over(within))
    return _merged(placed, ["tag", "bucket"]).withColumn("level", F.lit(level))


def _finest(points: DataFrame, width: int) -> DataFrame:
    return _level(_as_pieces(points), F.floor(F.col("last_t") / width).cast("long"), 0)


def _parents(nodes: DataFrame, level: int) -> DataFrame:
    """Nodes of a level from those below."""
    return _level(nodes.withColumnRenamed("bucket", "_below").drop("level"), F.floor(F.col("_below") / FAN).cast("long"), level)


def build_pyramid(df: DataFrame, tag: str, ts: str, value: str, width_seconds: int, levels: int = 4, good: str | None = None) -> DataFrame:
    """Nodes of all levels: ``tag, level, bucket`` and their sums. Only good points with a value count."""
    width = width_seconds * Ts._SECOND
    nodes = saved(_finest(Ts.usable(df, tag, ts, value, good), width), "nodes0")
    out = nodes
    for level in range(1, levels):
        nodes = saved(_parents(nodes, level), f"nodes{level}")
        out = out.unionByName(nodes)
    return out


def update_pyramid(
    pyramid: DataFrame, df: DataFrame, late: DataFrame, tag: str, ts: str, value: str, width_seconds: int, levels: int = 4, good: str | None = None
) -> DataFrame:
    """The pyramid after more points; ``df`` holds all points, those of ``late`` included.

    Only finest buckets that got points are read again, and only the nodes above them
    are merged again.
    """
    width = width_seconds * Ts._SECOND
    at = F.floor(F.col("t") / width).cast("long").alias("bucket")
    touched = saved(Ts.usable(late, tag, ts, value, good).select("tag", at).distinct(), "touched")
    points = _met(Ts.usable(df, tag, ts, value, good).withColumn("bucket", at), "bucket", touched, "left_semi").drop("bucket")
    fresh = saved(_finest(points, width), "fresh0")
    out: DataFrame | None = None
    for level in range(levels):
        kept = _met(pyramid.where(F.col("level") == level), "bucket", touched, "left_anti")
        own = kept.unionByName(fresh)
        out = own if out is None else out.unionByName(own)
        if level + 1 < levels:
            touched = touched.select("tag", F.floor(F.col("bucket") / FAN).cast("long").alias("bucket")).distinct()
            parent = F.floor(F.col("bucket") / FAN).cast("long")
            below = _met(own.withColumn("_up", parent), "_up", touched, "left_semi").drop("_up")
            fresh = saved(_parents(below, level + 1), f"fresh{level + 1}")
    return out


def _met(rows: DataFrame, bucket: str, touched: DataFrame, how: str) -> DataFrame:
    """Rows whose tag and bucket are touched or not; a null tag is a tag like any other."""
    keys = touched.select(F.struct("tag", "bucket").alias("_key"))
    return rows.join(keys, F.struct(F.col("tag"), F.col(bucket).alias("bucket")) == F.col("_key"), how)


def covering(first: int, last: int, levels: int) -> list[tuple[int, int, int]]:
    """``(level, from, to)`` of the nodes that cover the finest buckets ``first`` to ``last``."""
    out = []
    for level in range(levels):
        if first > last:
            break
        inner_first, inner_last = -(-first // FAN), (last + 1) // FAN - 1
        if level == levels - 1 or inner_first > inner_last:
            out.append((level, first, last))
            break
        out += [(level, a, b) for a, b in ((first, inner_first * FAN - 1), ((inner_last + 1) * FAN, last)) if a <= b]
        first, last = inner_first, inner_last
    return out


def before(bucket: int, levels: int) -> list[tuple[int, int | None, int]]:
    """``(level, from, to)`` of the nodes that cover everything before a finest bucket."""
    out: list[tuple[int, int | None, int]] = []
    for level in range(levels):
        if level == levels - 1:
            out.append((level, None, bucket - 1))
        elif bucket % FAN:
            out.append((level, bucket - bucket % FAN, bucket - 1))
        bucket //= FAN
    return out


def _nodes(pyramid: DataFrame, ranges: Sequence[tuple[int, int | None, int]]) -> DataFrame:
    keep = F.lit(False)
    for level, low, high in ranges:
        inside = (F.col("level") == level) & (F.col("bucket") <= high)
        keep = keep | (inside & (F.col("bucket") >= low) if low is not None else inside)
    return pyramid.where(keep)


def range_summary(
    pyramid: DataFrame, df: DataFrame, tag: str, ts: str, value: str, start: Any, end: Any, width_seconds: int, levels: int = 4,
    weighted: bool = True, types: Sequence[str] = Ts.SUMMARY_TYPES, good: str | None = None,
) -> DataFrame:
    """Summaries of ``[start, end)`` per tag, as ``ts_summary_time_weighted`` (or ``ts_summary``) gives them."""
    like, width = df.schema[ts].dataType, width_seconds * Ts._SECOND
    low, high = (df.sparkSession.range(1).select(Ts._instant(x)).first()[0] for x in (start, end))
    first, last = -(-low // width), high // width - 1
    points = lambda a, b: _as_pieces(Ts.usable(_between(df, ts, a, b), tag, ts, value, good))
    if first <= last:
        nodes = _nodes(pyramid, covering(first, last, levels)).drop("level", "bucket")
        pieces = nodes.unionByName(points(low, first * width)).unionByName(points((last + 1) * width, high))
    else:
        pieces = points(low, high)
    if not weighted:
        return _event_weighted(pieces, start, like, types)
    # the value that holds when the range starts
    bucket = low // width
    older = _nodes(pyramid, before(bucket, levels)).select("tag", "last_t", "last_v")
    older = older.unionByName(points(bucket * width, low).select("tag", "last_t", "last_v"))
    carried = older.groupBy("tag").agg(F.max_by("last_v", "last_t").alias("last_v"))
    zero = F.lit(0).cast("long")
    carried = carried.select(
        "tag", zero.alias("points"), F.lit(0.0).alias("total"), F.lit(0.0).alias("squares"), zero.alias("stretches"), F.lit(0.0).alias("wv"),
        F.lit(0.0).alias("wvv"), F.col("last_v").alias("low"), F.col("last_v").alias("high"), F.lit(low).cast("long").alias("first_t"),
        F.lit(low).cast("long").alias("last_t"), "last_v", F.lit(True).alias("carried"),
    )
    every = saved(pieces.withColumn("carried", F.lit(False)).unionByName(carried), "pieces")
    ahead = B.neighbours(every, ["tag"], ["first_t", "carried"], lambda w: {"_next": F.lead("first_t").over(w)}, before=False, split=None)
    ahead = ahead.withColumn("_ahead", F.coalesce("_next", F.lit(high).cast("long")))
    # a point at the very start leaves nothing of the value before it
    lasting = ahead.where(~F.col("carried") | (F.col("_ahead") > F.col("last_t"))).withColumn(
        "stretches", F.col("stretches") + F.col("carried").cast("long")
    )
    sums = _merged(lasting, ["tag"]).withColumn("w", (F.lit(high) - F.col("first_t")).cast("double"))
    mean = F.col("wv") / F.col("w")
    wide = sums.select(
        "tag", F.lit(start).cast(like).alias("timestamp"), (F.col("wv") / Ts._DAY).alias("Total"), mean.alias("Average"), F.col("low").alias("Minimum"),
        F.col("high").alias("Maximum"), (F.col("high") - F.col("low")).alias("Range"),
        F.sqrt(F.greatest(F.col("wvv") / F.col("w") - mean * mean, F.lit(0.0))).alias("StdDev"), F.col("stretches").cast("double").alias("Count"),
    )
    return Ts._wide_to_long(wide, ["tag", "timestamp"], types)


def _event_weighted(pieces: DataFrame, start: Any, like, types: Sequence[str]) -> DataFrame:
    sums = pieces.groupBy("tag").agg(
        F.sum("points").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    spread = F.when(F.col("n") > 1, F.sqrt(F.greatest((F.col("squares") - F.col("total") * F.col("total") / F.col("n")) / (F.col("n") - 1), F.lit(0.0))))
    wide = sums.select(
        "tag", F.lit(start).cast(like).alias("timestamp"), F.col("total").alias("Total"), (F.col("total") / F.col("n")).alias("Average"),
        F.col("low").alias("Minimum"), F.col("high").alias("Maximum"), (F.col("high") - F.col("low")).alias("Range"), spread.alias("StdDev"),
        F.col("n").cast("double").alias("Count"),
    )
    return Ts._wide_to_long(wide, ["tag", "timestamp"], types)


def _between(df: DataFrame, ts: str, low: int, high: int) -> DataFrame:
    """Rows in ``[low, high)`` microseconds, as bounds of the column's own type that reach the scan."""
    kind = df.schema[ts].dataType
    at = lambda m: F.timestamp_micros(F.lit(m)).cast(kind)
    return df.where((F.col(ts) >= at(low)) & (F.col(ts) < at(high)))
