"""Cursor algebra: what to read next and where to stop."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators.paging import cap_records
from tidemark.plans.apply import payload_hash


def _bound(df: DataFrame, cursor: str, value: Any) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast(df.schema[cursor].dataType)


def cap_at_start(df: DataFrame, cursor: str, init: Any) -> DataFrame:
    """Rows past the bound frozen at start wait for the next run."""
    return df.where(F.col(cursor) <= _bound(df, cursor, init))


def next_cursor(df: DataFrame, cursor: str, prev: Any, cap: Any) -> DataFrame:
    """The cursor after a batch: capped, never behind ``prev``; equal means drained."""
    kind = df.schema[cursor].dataType
    before = F.lit(prev).cast(kind)
    newest = F.least(F.max(cursor), _bound(df, cursor, cap))
    # greatest() skips nulls: an empty batch keeps the previous cursor
    moved = df.agg(F.greatest(before, newest).alias("next_cursor"))
    return moved.withColumn("drained", F.coalesce(F.col("next_cursor") == before, F.col("next_cursor").isNull()))


def lookback_read(df: DataFrame, cursor: str, prev: Any, seconds: int, cap: Any = None, inclusive: bool = True) -> DataFrame:
    """Read again from a little before the stored cursor; the cursor itself stays."""
    low = S.apply_lookback(_bound(df, cursor, prev), seconds)
    out = df.where(F.col(cursor) >= low if inclusive else F.col(cursor) > low)
    return out if cap is None else cap_at_start(out, cursor, cap)


def lookback_days_read(df: DataFrame, cursor: str, prev: Any, hours: int, cap: Any = None) -> DataFrame:
    """Look back in hours on a source that takes days: the whole day of the start is read."""
    low = (F.lit(prev).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours))).cast("date")
    out = df.where(F.col(cursor) >= low.cast(df.schema[cursor].dataType))
    return out if cap is None else cap_at_start(out, cursor, cap)


def admission_rows(
    df: DataFrame, cursor: str, tie: str, max_records: int, last: Any = None, last_tie: Any = None, cap: Any = None
) -> tuple[DataFrame, DataFrame]:
    """A bounded micro-batch and its resume point."""
    waiting = df if cap is None else cap_at_start(df, cursor, cap)
    return cap_records(waiting, cursor, tie, max_records, last, last_tie)


def admission_days(df: DataFrame, cursor: str, since: Any, days: int, cap: Any) -> tuple[DataFrame, Column]:
    """At most ``days`` days per batch; the cursor moves on even over an empty span."""
    kind = df.schema[cursor].dataType
    start = F.lit(since).cast("date")
    end = F.least(F.date_add(start, days), F.lit(cap).cast("date"))
    rows = df.where((F.col(cursor) >= start.cast(kind)) & (F.col(cursor) < end.cast(kind)))
    return rows, end


def early_exit(df: DataFrame, cursor: str, prev: Any) -> bool:
    """Whether nothing is newer than the stored cursor (one value read back)."""
    return df.where(F.col(cursor) > _bound(df, cursor, prev)).isEmpty()


def early_exit_flag(df: DataFrame, cursor: str, prev: Any) -> DataFrame:
    newest = df.agg(F.max(cursor).alias("max_cursor"))
    return newest.withColumn("skip", F.coalesce(F.col("max_cursor") <= _bound(df, cursor, prev), F.lit(True)))


def forward_horizon(df: DataFrame, cursor: str, init: Any, days: int) -> DataFrame:
    """Rows dated up to ``days`` after the start of the run."""
    last = F.date_add(F.lit(init).cast("date"), days + 1).cast(df.schema[cursor].dataType)
    return df.where(F.col(cursor) < last)


def assert_filter_honoured(df: DataFrame, cursor: str, since: Any) -> DataFrame:
    """Fail if a filtered read returned only rows that are not newer than asked for."""
    low = _bound(df, cursor, since)
    counted = df.agg(
        F.count(cursor).alias("datable"), F.count_if(F.col(cursor) <= low).alias("stale")
    )
    ignored = (F.col("datable") > 0) & (F.col("stale") == F.col("datable"))
    message = F.lit(f"the source ignored the filter on {cursor}")
    return counted.withColumn("honoured", F.when(ignored, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def filter_honoured(df: DataFrame, cursor: str, since: Any) -> DataFrame:
    """The counts behind ``assert_filter_honoured`` without the error."""
    low = _bound(df, cursor, since)
    counted = df.agg(F.count(cursor).alias("datable"), F.count_if(F.col(cursor) <= low).alias("stale"))
    return counted.withColumn("honoured", (F.col("datable") == 0) | (F.col("stale") < F.col("datable")))


def multi_series_resume(df: DataFrame, tag: str, ts: str) -> DataFrame:
    """Where the slowest series stands: its last time plus one microsecond."""
    last = df.groupBy(tag).agg(F.max(ts).alias("last_ts"))
    step = F.make_dt_interval(secs=F.lit("0.000001").cast("decimal(18,6)"))
    return last.agg((F.min("last_ts") + step).alias("next_start"))


def dedupe_points(df: DataFrame, tag: str, ts: str) -> DataFrame:
    """Faster series are read again from the slowest one's mark; keep one row per point.

    Copies that differ are settled by their hash, so a retried task keeps the same one.
    """
    best = df.groupBy(tag, ts).agg(F.max_by(F.struct(*df.columns), payload_hash(df, df.columns)).alias("r"))
    return best.select("r.*")


def resume_by_key_order(df: DataFrame, key: str, last: Any) -> DataFrame:
    """Go on with a key-ordered walk at the last finished key; an unknown key starts over."""
    if last is None:
        return df
    known = df.select(F.max(F.col(key) == F.lit(last)).alias("known"))
    return df.where(~F.coalesce(known.scalar(), F.lit(False)) | (F.col(key) >= F.lit(last)))


def resume_state(
    marks: DataFrame, previous: DataFrame, key: str, in_flight: DataFrame | None = None
) -> DataFrame:
    """Cursor table after a run: finished entities take their new mark, others keep the old.

    ``in_flight`` names entities cut short with the position inside them; they
    keep the old mark and carry a ``resume`` struct.
    """
    old = previous if "resume" in previous.columns else previous.withColumn("resume", F.lit(None).cast("string"))
    new = marks.select(F.col(key), F.col("watermark").alias("_new"))
    prev = old.select(F.col(key).alias("_k"), F.col("watermark").alias("_old"), F.col("resume").alias("_resume"))
    joined = new.join(prev, F.col(key) == F.col("_k"), "full_outer")
    out = joined.select(
        F.coalesce(F.col(key), F.col("_k")).alias(key), "_new", "_old", "_resume"
    )
    if in_flight is None:
        return out.select(key, F.greatest("_new", "_old").alias("watermark"), F.lit(None).cast("string").alias("resume"))
    cut = in_flight.select(F.col(key).alias("_c"), F.col("resume").cast("string").alias("_at"))
    out = out.join(cut, F.col(key) == F.col("_c"), "full_outer").withColumn(key, F.coalesce(F.col(key), F.col("_c")))
    return out.select(
        key,
        F.when(F.col("_c").isNotNull(), F.col("_old")).otherwise(F.greatest("_new", "_old")).alias("watermark"),
        F.col("_at").alias("resume"),
    )


def legacy_marks(df: DataFrame, key: str, raw: str) -> DataFrame:
    """Stored offsets as marks: ``{"marks": {k: ts}}`` or the older flat ``{k: ts}``."""
    modern = F.from_json(F.get_json_object(raw, "$.marks"), "map<string,string>")
    flat = F.map_filter(F.from_json(F.col(raw), "map<string,string>"), lambda k, v: k != "marks")
    pairs = df.select(F.explode(F.coalesce(modern, flat)).alias(key, "_at"))
    return pairs.select(key, S.parse_ts_any(F.col("_at")).alias("watermark"))


def batch_windows(df: DataFrame, cursor: str, start: Any, window_days: int, cap: Any) -> DataFrame:
    """Window number of each row for window-sized batches; a starting date is required."""
    if start is None:
        raise ValueError("a starting date is required")
    kind = df.schema[cursor].dataType
    low = F.lit(start).cast("date")
    inside = df.where((F.col(cursor) >= low.cast(kind)) & (F.col(cursor) <= F.lit(cap).cast(kind)))
    number = F.floor(F.date_diff(F.col(cursor).cast("date"), low) / window_days).cast("int")
    return inside.withColumn("batch", number)


