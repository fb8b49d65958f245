"""Time-series operators on long frames ``(tag, ts, value)``.

Only good points with a value count.  A value on a bucket edge belongs to the
bucket it starts.  Work is grouped by ``(tag, bucket)`` or by ``(tag, block)``,
never by tag alone, so one huge tag spreads over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans import blocks as B
from tidemark.plans.apply import payload_hash

SUMMARY_TYPES = ("Total", "Average", "Minimum", "Maximum", "Range", "StdDev", "Count")
_SECOND = 1000000
_DAY = 86400 * _SECOND


def micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def _instant(value: Any) -> Column:
    return micros(value if isinstance(value, Column) else F.lit(value))


def usable(df: DataFrame, tag: str, ts: str, value: str, good: str | None = None) -> DataFrame:
    keep = F.col(value).isNotNull() & F.col(ts).isNotNull()
    if good:
        keep = keep & F.coalesce(F.col(good), F.lit(True))
    return df.where(keep).select(
        F.col(tag).alias("tag"), micros(F.col(ts)).alias("t"), F.col(value).cast("double").alias("v")
    )


def in_range(df: DataFrame, ts: str, start: Any, end: Any) -> DataFrame:
    kind = df.schema[ts].dataType
    return df.where((F.col(ts) >= F.lit(start).cast(kind)) & (F.col(ts) < F.lit(end).cast(kind)))


def explode_numbers(df: DataFrame, name: str, first: Column, last: Column, chunk: int = 8192) -> DataFrame:
    """A row per whole number of ``first .. last``; nothing where the range is empty.

    Unfolded in two steps, so that a row never holds an array longer than
    ``chunk`` numbers or than the count of chunks.
    """
    some = df.withColumn("_first", first).withColumn("_last", last).where(F.col("_first") <= F.col("_last"))
    steps = F.sequence(F.col("_first"), F.col("_last"), F.lit(chunk).cast("bigint"))
    split = some.withColumn("_step", F.explode(steps))
    inner = F.sequence(F.col("_step"), F.least(F.col("_step") + chunk - 1, F.col("_last")))
    return split.withColumn(name, F.explode(inner)).drop("_first", "_last", "_step")


def _bucket(t: Column, start: Column, width: int) -> Column:
    return F.floor((t - start) / width).cast("long")


def _as_time(t: Column, like: Any) -> Column:
    return F.timestamp_micros(t).cast(like)


def _wide_to_long(df: DataFrame, keep: Sequence[str], types: Sequence[str]) -> DataFrame:
    unknown = set(types) - set(SUMMARY_TYPES)
    if unknown:
        raise ValueError(f"unknown summary types {sorted(unknown)}")
    return df.unpivot(list(keep), list(types), "summary_type", "value")


def ts_summary(
    df: DataFrame, tag: str, ts: str, value: str, start: Any, end: Any,
    duration_seconds: int | None = None, types: Sequence[str] = SUMMARY_TYPES, good: str | None = None,
) -> DataFrame:
    """Event-weighted summaries per tag over ``[start, end)``, whole or per bucket."""
    like = df.schema[ts].dataType
    points = usable(in_range(df, ts, start, end), tag, ts, value, good)
    low = _instant(start)
    width = duration_seconds * _SECOND if duration_seconds else None
    bucket = _bucket(F.col("t"), low, width) if width else F.lit(0).cast("long")
    wide = points.groupBy("tag", bucket.alias("b")).agg(
        F.sum("v").alias("Total"),
        F.avg("v").alias("Average"),
        F.min("v").alias("Minimum"),
        F.max("v").alias("Maximum"),
        (F.max("v") - F.min("v")).alias("Range"),
        F.stddev_samp("v").alias("StdDev"),
        F.count("v").cast("double").alias("Count"),
    )
    timed = wide.withColumn("timestamp", _as_time(low + F.col("b") * (width or 0), like)).drop("b")
    return _wide_to_long(timed, ["tag", "timestamp"], types)


def segments(points: DataFrame, low: Column, high: Column) -> DataFrame:
    """Stretches ``[t, until)`` on which a tag holds one value, clipped to the range."""
    single = points.groupBy("tag", "t").agg(F.max("v").alias("v"))
    split = B.find_split(points, ["tag"], "t")
    ahead = B.neighbours(single, ["tag"], ["t"], lambda w: {"until": F.lead("t").over(w)}, before=False, split=split)
    clipped = ahead.select(
        "tag", F.greatest("t", low).alias("t"), F.least(F.coalesce("until", high), high).alias("until"), "v"
    )
    return clipped.where(F.col("t") < F.col("until"))


def ts_summary_time_weighted(
    df: DataFrame, tag: str, ts: str, value: str, start: Any, end: Any,
    duration_seconds: int | None = None, types: Sequence[str] = SUMMARY_TYPES, good: str | None = None,
) -> DataFrame:
    """Summaries weighted by how long each value holds (until the next point).

    A value carries on over bucket edges, also from before ``start``.  ``Total``
    is the integral per day, ``Count`` the number of stretches, ``StdDev`` the
    population form.
    """
    like = df.schema[ts].dataType
    kept = df.where(F.col(ts) < F.lit(end).cast(like))
    low, high = _instant(start), _instant(end)
    held = segments(usable(kept, tag, ts, value, good), low, high)
    width = duration_seconds * _SECOND if duration_seconds else None
    if width:
        first, last = _bucket(F.col("t"), low, width), _bucket(F.col("until") - 1, low, width)
        held = explode_numbers(held, "b", first, last)
        edge = low + F.col("b") * width
        held = held.withColumn("dt", (F.least("until", edge + width) - F.greatest("t", edge)).cast("double"))
    else:
        held = held.withColumn("b", F.lit(0).cast("long")).withColumn("dt", (F.col("until") - F.col("t")).cast("double"))
    sums = held.groupBy("tag", "b").agg(
        F.sum("dt").alias("w"),
        F.sum(F.col("v") * F.col("dt")).alias("wv"),
        F.sum(F.col("v") * F.col("v") * F.col("dt")).alias("wvv"),
        F.min("v").alias("Minimum"),
        F.max("v").alias("Maximum"),
        F.count("*").cast("double").alias("Count"),
    )
    mean = F.col("wv") / F.col("w")
    wide = sums.select(
        "tag",
        _as_time(low + F.col("b") * (width or 0), like).alias("timestamp"),
        (F.col("wv") / _DAY).alias("Total"),
        mean.alias("Average"),
        "Minimum",
        "Maximum",
        (F.col("Maximum") - F.col("Minimum")).alias("Range"),
        F.sqrt(F.greatest(F.col("wvv") / F.col("w") - mean * mean, F.lit(0.0))).alias("StdDev"),
        "Count",
    )
    return _wide_to_long(wide, ["tag", "timestamp"], types)


CALCULATIONS = {
    "total": F.sum,
    "average": F.avg,
    "minimum": F.min,
    "maximum": F.max,
    "count": F.count,
    "first": None,
    "last": None,
}


def ts_calculated(
    df: DataFrame, tag: str, ts: str, value: str, start: Any, end: Any, interval_seconds: int, calc: str,
    good: str | None = None,
) -> DataFrame:
    """One calculated value per tag and interval."""
    if calc not in CALCULATIONS:
        raise ValueError(f"unknown calculation {calc!r}")
    like = df.schema[ts].dataType
    points = usable(in_range(df, ts, start, end), tag, ts, value, good)
    low, width = _instant(start), interval_seconds * _SECOND
    if calc in ("first", "last"):
        result = (F.min_by if calc == "first" else F.max_by)("v", "t")
    else:
        result = CALCULATIONS[calc]("v")
    out = points.groupBy("tag", _bucket(F.col("t"), low, width).alias("b")).agg(result.cast("double").alias("value"))
    return out.select("tag", _as_time(low + F.col("b") * width, like).alias("timestamp"), "value")


def ts_plot(
    df: DataFrame, tag: str, ts: str, value: str, start: Any, end: Any, intervals: int, good: str | None = None
) -> DataFrame:
    """First, last, lowest and highest point of each of ``intervals`` buckets."""
    like = df.schema[ts].dataType
    points = usable(in_range(df, ts, start, end), tag, ts, value, good)
    low, high = _instant(start), _instant(end)
    bucket = F.floor((F.col("t") - low) * intervals / (high - low)).cast("long")
    point = F.struct("t", "v")
    picked = points.groupBy("tag", bucket.alias("b")).agg(
        F.array_distinct(
            F.array(
                F.min(F.struct("t", "v")),
                F.max(F.struct("t", "v")),
                F.min_by(point, F.struct("v", "t")),
                F.max_by(point, F.struct(F.col("v"), -F.col("t"))),
            )
        ).alias("points")
    )
    return picked.select("tag", F.explode("points").alias("p")).select(
        "tag", _as_time(F.col("p.t"), like).alias("timestamp"), F.col("p.v").alias("value")
    )


def ts_interpolate(
    df: DataFrame, tag: str, ts: str, value: str, start: Any, end: Any, interval_seconds: int, good: str | None = None
) -> DataFrame:
    """Linear values on the grid ``start, start + interval, .. end`` per tag.

    Each stretch between two points yields its own grid times, so nothing is
    joined to the grid.  Grid times before the first or after the last point
    of a tag come out null.
    """
    like = df.schema[ts].dataType
    low, high, step = _instant(start), _instant(end), interval_seconds * _SECOND
    raw = usable(df, tag, ts, value, good)
    split = B.find_split(raw, ["tag"], "t")
    points = raw.groupBy("tag", "t").agg(F.max("v").alias("v"))
    ahead = B.neighbours(
        points, ["tag"], ["t"], lambda w: {"t2": F.lead("t").over(w), "v2": F.lead("v").over(w)}, before=False, split=split
    )
    last_step = F.floor((high - low) / step).cast("long")

    def grid(frm: Column, to: Column) -> tuple[Column, Column]:
        """First and last number of the grid times in ``[frm, to)``."""
        first = F.greatest(F.ceil((frm - low) / step).cast("long"), F.lit(0).cast("long"))
        return first, F.least(F.ceil((to - low) / step).cast("long") - 1, last_step)

    at = low + F.col("g") * step
    slope = (F.col("v2") - F.col("v")) * (at - F.col("t")) / (F.col("t2") - F.col("t"))
    value_at = F.when(F.col("t2").isNull() | (at == F.col("t")), F.col("v")).otherwise(F.col("v") + slope)
    until = F.coalesce(F.col("t2"), F.col("t") + 1)
    inner = explode_numbers(ahead, "g", *grid(F.col("t"), until)).select("tag", at.alias("at"), value_at.alias("value"))
    reach = points.groupBy("tag").agg(F.min("t").alias("t1"), F.max("t").alias("tn"))
    empty = F.lit(None).cast("double").alias("value")
    head = explode_numbers(reach, "g", *grid(low, F.col("t1"))).select("tag", at.alias("at"), empty)
    tail = explode_numbers(reach, "g", *grid(F.col("tn") + 1, high + 1)).select("tag", at.alias("at"), empty)
    outer = head.unionByName(tail)
    return inner.unionByName(outer).select("tag", _as_time(F.col("at"), like).alias("timestamp"), "value")


def end_value(df: DataFrame, tag: str, ts: str) -> DataFrame:
    """Latest row of each tag; rows of the same time are settled by their hash."""
    order = F.struct(ts, payload_hash(df, df.columns).alias("_tie"))
    return df.groupBy(tag).agg(F.max_by(F.struct(*df.columns), order).alias("r")).select("r.*")


def current_value(df: DataFrame, tag: str, ts: str, now: Any) -> DataFrame:
    """Latest row of each tag that is not in the future."""
    return end_value(df.where(F.col(ts) <= F.lit(now).cast(df.schema[ts].dataType)), tag, ts)


def value_at_time(df: DataFrame, tag: str, ts: str, when: Any, exact: bool = False) -> DataFrame:
    """Last recorded row at or before ``when`` per tag, or exactly at it."""
    at = F.lit(when).cast(df.schema[ts].dataType)
    return end_value(df.where(F.col(ts) == at if exact else F.col(ts) <= at), tag, ts)


def values_at(probes: DataFrame, points: DataFrame, tag: str, ts: str, value: str) -> DataFrame:
    """As-of look-up for many ``(tag, ts)`` probes: last value at or before each.

    Probes and points run through one ordered pass per block; a block without
    points takes over the last value of an earlier block.  Of several values at
    one time the largest counts.
    """
    kind = points.schema[ts].dataType
    both = points.select(F.col(tag), F.col(ts), F.col(value).alias("_v"), F.lit(0).alias("_probe")).unionByName(
        probes.select(F.col(tag), F.col(ts).cast(kind).alias(ts), F.lit(None).alias("_v"), F.lit(1).alias("_probe"))
    )
    split = B.find_split(both, [tag], ts)
    blocked = split.add(both)
    hit = F.struct("_v")
    inside = Window.partitionBy(tag, B.BLOCK).orderBy(ts, "_probe", "_v").rowsBetween(Window.unboundedPreceding, 0)
    seen = blocked.withColumn("_seen", F.last(F.when(F.col("_probe") == 0, hit), ignorenulls=True).over(inside))
    answers = seen.where(F.col("_probe") == 1)
    if split.plain:
        return answers.select(tag, ts, F.col("_seen._v").alias(value))
    # last value of each block of a hot tag, handed on over blocks without points
    ends = blocked.where(split.is_hot()).groupBy(tag, B.BLOCK).agg(
        F.max(F.when(F.col("_probe") == 0, F.struct(ts, "_v"))).alias("_end")
    )
    back = Window.partitionBy(tag).orderBy(B.BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_end", F.when(F.col("_end").isNotNull(), F.struct(F.col("_end._v").alias("_v"))))
    carry = ends.select(tag, B.BLOCK, F.last("_end", ignorenulls=True).over(back).alias("_carry"))
    return answers.join(carry, [tag, B.BLOCK], "left").select(
        tag, ts, F.coalesce("_seen", "_carry")["_v"].alias(value)
    )
