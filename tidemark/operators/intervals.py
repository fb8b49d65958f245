"""Overlaps of two interval tables as equi-joins on hierarchical slots.

Two intervals overlap if one starts within the other. An interval is cut into the fewest
slots that cover it, slots of level ``n`` being ``FAN ** n`` times as wide as the finest:
a long interval takes a few wide slots and is never copied to every narrow one. A
start lies in one slot of each level. So each pair meets exactly once, on a slot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import saved

#: Slots of a level that make one of the next.
FAN = 8


def _number(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("long")
    raise TypeError(f"cannot lay {kind.simpleString()} out in slots")


def _numbered(df: DataFrame, start: str, end: str, by: Sequence[str]) -> DataFrame:
    """The rows as ``row`` with numeric ends; a null end is open, a null start or a reversed interval is none."""
    low, high = _number(df, start), _number(df, end)
    rows = df.select(F.struct(*[F.col(f"`{b}`") for b in by], F.lit(0)).alias("by"), low.alias("s"), high.alias("e"), F.struct(*df.columns).alias("row"))
    return rows.where(F.col("s").isNotNull() & (F.col("e").isNull() | (F.col("e") >= F.col("s"))))


def cover(first: Column, last: Column, levels: int) -> Column:
    """The fewest slots, as ``{level, slot}``, whose union are the finest slots ``first`` to ``last``."""
    parts = []
    for level in range(levels + 1):
        size, wide = FAN**level, FAN ** (level + 1)
        least = F.ceil(first / F.lit(size)).cast("long") if level else first
        most = (F.floor((last + 1) / F.lit(size)).cast("long") - 1) if level else last
        if level == levels:
            inner_low, inner_high = F.lit(1).cast("long"), F.lit(0).cast("long")
        else:
            inner_low = F.ceil(first / F.lit(wide)).cast("long")
            inner_high = F.floor((last + 1) / F.lit(wide)).cast("long") - 1
        # what the next level covers is left out
        some = inner_low <= inner_high
        left_end = F.when(some, inner_low * FAN - 1).otherwise(most)
        right_start = F.when(some, (inner_high + 1) * FAN).otherwise(most + 1)
        slots = F.concat(_run(least, left_end), _run(right_start, most))
        parts.append(F.transform(slots, _at(level)))
    return F.concat(*parts)


def _at(level: int):
    return lambda slot: F.struct(F.lit(level).alias("level"), slot.alias("slot"))


def _run(low: Column, high: Column) -> Column:
    return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))


def _within(starts: DataFrame, spans: DataFrame, origin: int, unit: int, levels: int, strict: bool) -> DataFrame:
    """Pairs of a start and the span it lies in; ``strict``: not at the span's own start."""
    slot = lambda c: F.expr(f"({c} - {origin}) div {unit}")
    laid = spans.withColumn("at", F.explode(cover(slot("s"), slot("e"), levels))).select(
        F.col("by").alias("_by"), F.col("s").alias("_s"), F.col("e").alias("_e"), F.col("row").alias("_row"), "at.level", "at.slot"
    )
    laid = saved(laid, "spans")
    used = sorted(r["level"] for r in laid.select("level").distinct().collect())
    if not used:
        used = [0]
    above = F.array(*[F.struct(F.lit(n).alias("_level"), F.expr(f"(s - {origin}) div {unit} div {FAN**n}").alias("_slot")) for n in used])
    # a start above all spans, or between their slots, meets nothing
    points = starts.withColumn("at", F.explode(above)).select("by", "s", "row", "at._level", "at._slot")
    met = points.join(laid, (F.col("by") == F.col("_by")) & (F.col("_level") == F.col("level")) & (F.col("_slot") == F.col("slot")))
    exact = (F.col("s") > F.col("_s")) if strict else (F.col("s") >= F.col("_s"))
    return met.where(exact & (F.col("s") <= F.col("_e"))).select("row", "_row")


def overlapping_pairs(
    left: DataFrame, right: DataFrame, start: str = "start_time", end: str = "end_time", by: Sequence[str] = (), right_start: str = "", right_end: str = ""
) -> DataFrame:
    """Pairs ``left``, ``right`` (the rows as structs) of intervals that share a point, both ends included.

    A null end is open; rows without a start, or that end before they start, overlap nothing.
    With ``by`` only rows with equal values meet (nulls are equal). The slot width follows
    the middle length of the intervals; any width gives the same pairs.
    """
    a = saved(_numbered(left, start, end, by), "left")
    b = saved(_numbered(right, right_start or start, right_end or end, by), "right")
    both = a.select("s", "e").unionByName(b.select("s", "e"))
    seen = both.agg(F.min("s"), F.max(F.greatest("s", "e")), F.percentile_approx(F.col("e") - F.col("s"), 0.5)).first()
    if seen[0] is None:
        seen = (0, 0, 0)
    origin, top, unit = seen[0], seen[1], max(1, seen[2] or 0)
    levels = 0
    while FAN**levels * unit <= top - origin:
        levels += 1
    a, b = (x.withColumn("e", F.coalesce("e", F.lit(top))) for x in (a, b))
    first = _within(b, a, origin, unit, levels, strict=False).select(F.col("_row").alias("left"), F.col("row").alias("right"))
    second = _within(a, b, origin, unit, levels, strict=True).select(F.col("row").alias("left"), F.col("_row").alias("right"))
    return first.unionByName(second)
