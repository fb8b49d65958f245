"""Exact distinct users over any range of days, from kept bitmaps.

Users get dense numbers once, in a dictionary that only grows. A day's users are bitmaps
of their numbers, one per 32,768 numbers that occur. Bitmaps are combined by ``or``, so
late rows are added to what is kept, a range is the ``or`` of its days, and counts are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.blocks import running_position

ID, NUMBER, DAY, BUCKET, BITS = "user", "number", "day", "bucket", "bits"


def number_users(rows: DataFrame, user: str, known: DataFrame | None = None) -> DataFrame:
    """Dictionary ``user, number``: the known one and the next numbers for users it lacks. Null is no user."""
    seen = rows.select(F.col(user).alias(ID)).where(F.col(ID).isNotNull()).distinct()
    if known is None:
        return running_position(seen, [ID], NUMBER).select(ID, F.col(NUMBER).cast("long").alias(NUMBER))
    top = known.agg(F.max(NUMBER)).first()[0] or 0
    fresh = running_position(seen.join(known.select(ID), ID, "left_anti"), [ID], NUMBER)
    return known.select(ID, NUMBER).unionByName(fresh.select(ID, (F.col(NUMBER) + F.lit(top)).cast("long").alias(NUMBER)))


def day_bitmaps(rows: DataFrame, users: DataFrame, user: str, ts: str, dims: Sequence[str] = ()) -> DataFrame:
    """``dims, day, bucket, bits`` of the rows; each user counts once per day before the dictionary is met."""
    seen = rows.select(*dims, F.to_date(ts).alias(DAY), F.col(user).alias(ID)).where(F.col(ID).isNotNull() & F.col(DAY).isNotNull()).distinct()
    numbered = seen.join(users, ID).withColumn(BUCKET, F.bitmap_bucket_number(NUMBER))
    return numbered.groupBy(*dims, DAY, BUCKET).agg(F.bitmap_construct_agg(F.bitmap_bit_position(NUMBER)).alias(BITS))


def add_days(kept: DataFrame, more: DataFrame) -> DataFrame:
    """Kept bitmaps with those of new or late rows; adding the same rows again changes nothing."""
    keys = [c for c in kept.columns if c != BITS]
    return kept.unionByName(more).groupBy(*keys).agg(F.bitmap_or_agg(BITS).alias(BITS))


def _counted(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    merged = parts.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))
    return merged.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count(BITS)), F.lit(0)).alias("users"))


def users_between(kept: DataFrame, start, end, dims: Sequence[str] = ()) -> DataFrame:
    """Distinct users of the days ``start`` to ``end``, both included, per ``dims``."""
    days = kept.where(F.col(DAY).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return _counted(days, dims)


def rolling_users(kept: DataFrame, days: int, dims: Sequence[str] = ()) -> DataFrame:
    """Distinct users of the last ``days`` days up to each day that has any; copies bitmaps, not rows."""
    ends = kept.select(*dims, F.col(DAY).alias("_end")).distinct()
    spread = kept.withColumn("_end", F.explode(F.sequence(F.col(DAY), F.date_add(DAY, days - 1))))
    met = spread.join(ends, [*dims, "_end"], "left_semi")
    return _counted(met, [*dims, "_end"]).withColumnRenamed("_end", DAY)
