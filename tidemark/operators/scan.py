"""Scans of landed tables: full, by cursor range, by window, by change log."""

from __future__ import annotations

import re
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import scalars as S
from tidemark.operators.paging import keyset_page
from tidemark.plans import blocks as B

CORRUPT = "_corrupt"
# Envelope keys tried in this order when none is named.
ENVELOPE_HINTS = ("records", "items", "data", "results", "entries", "values", "elements")


def time_like(df: DataFrame, column: str, value: Any) -> Column:
    """A literal or Column as the type of ``column``, so that the range stays pushable."""
    bound = value if isinstance(value, Column) else F.lit(value)
    return bound.cast(df.schema[column].dataType)


def scan_snapshot(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Full read of a table under its declared schema."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt != "parquet":
        raise ValueError("a declared schema is needed for raw files")
    return reader.load(path)


def scan_incremental(
    df: DataFrame, cursor: str, since: Any = None, until: Any = None, bounds: str = "(]"
) -> DataFrame:
    """Rows in the cursor range; ``bounds`` says which end belongs to it."""
    if bounds not in ("(]", "[]", "[)", "()"):
        raise ValueError(f"unknown bounds {bounds!r}")
    c = F.col(cursor)
    if since is not None:
        low = time_like(df, cursor, since)
        df = df.where(c > low if bounds[0] == "(" else c >= low)
    if until is not None:
        high = time_like(df, cursor, until)
        df = df.where(c < high if bounds[1] == ")" else c <= high)
    return df


def scan_by_limit(
    df: DataFrame, cursor: str, tie: str, since: Any, limit: int, since_tie: Any = None
) -> DataFrame:
    """The first ``limit`` rows after the cursor position, in cursor order."""
    return keyset_page(df, cursor, tie, since, since_tie, limit)


def scan_by_window(
    df: DataFrame, cursor: str, since: Any, window_seconds: int, cap: Any
) -> tuple[DataFrame, Column]:
    """One window ``(since, since + window]`` and the cursor after it.

    The cursor moves to the window end even if no row lies inside.
    """
    start = time_like(df, cursor, since)
    end = S.window_end(start, window_seconds, time_like(df, cursor, cap))
    return df.where((F.col(cursor) > start) & (F.col(cursor) <= end)), end


def scan_compacted_windows(
    df: DataFrame, cursor: str, since: datetime, window_seconds: int, cap: datetime, max_records: int
) -> DataFrame:
    """Whole windows after ``since`` until ``max_records`` is reached.

    Empty windows are skipped; the window that reaches the mark is still read
    in full, so no row of a taken window is lost.  The result carries the
    window end as ``window_until``.
    """
    start = time_like(df, cursor, since)
    end = time_like(df, cursor, cap)
    inside = scan_incremental(df, cursor, since, cap)
    kind = df.schema[cursor].dataType
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    step = window_seconds * 1000000
    number = F.floor((micros(F.col(cursor)) - micros(start) - 1) / step).cast("long")
    numbered = inside.withColumn("_window", number)
    counts = numbered.groupBy("_window").agg(F.count("*").alias("_rows"))
    ahead = B.running_position(counts, ["_window"], "_upto", F.col("_rows"))
    taken = ahead.where(F.col("_upto") - F.col("_rows") < max_records).select("_window")
    until = F.timestamp_micros(micros(start) + (F.col("_window") + 1) * step).cast(kind)
    return (
        numbered.join(taken, "_window", "left_semi")
        .withColumn("window_until", F.least(until, end))
        .drop("_window")
    )


def plan_windows(
    bounds: DataFrame, start: str, end: str, days: int, lookback_minutes: int = 0, first_run_before: str = "1971-01-01"
) -> DataFrame:
    """Split ``(start, end]`` of every row of ``bounds`` into windows of ``days``.

    Gives the other columns of ``bounds`` (an entity, say) with ``window_id``,
    ``since`` and ``until``.  A start before ``first_run_before`` is a first
    run: one window from the epoch.  ``start >= end`` plans nothing.
    """
    keep = [c for c in bounds.columns if c not in (start, end)]
    ends = bounds.select(
        *keep, F.col(start).cast("timestamp").alias("_from"), F.col(end).cast("timestamp").alias("_to")
    ).where(F.col("_from") < F.col("_to"))
    first = F.col("_from") <= F.lit(first_run_before).cast("timestamp")
    low = F.col("_from") - F.make_dt_interval(mins=F.lit(lookback_minutes))
    step = F.make_dt_interval(days=F.lit(days))
    starts = F.when(first, F.array(F.lit("1970-01-01").cast("timestamp"))).otherwise(
        F.filter(F.sequence(low, F.col("_to"), step), lambda s: s < F.col("_to"))
    )
    planned = ends.select(*keep, "_to", first.alias("_first"), F.posexplode(starts).alias("window_id", "since"))
    until = F.when(F.col("_first"), F.col("_to")).otherwise(F.least(F.col("since") + step, F.col("_to")))
    return planned.select(*keep, "window_id", "since", until.alias("until"))


def scan_partitioned(
    df: DataFrame, cursor: str, windows: DataFrame, partitions: int | None = None, grain_seconds: int = 86400
) -> DataFrame:
    """Rows of each planned window, tagged with ``window_id``.

    The range join runs as an equi-join on a time slot: a window is listed once
    per slot it touches, a row has exactly one slot.  AQE splits a hot slot.
    """
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    grain = grain_seconds * 1000000
    slot = lambda c: F.floor(micros(c) / grain).cast("long")
    spread = windows.select(
        "window_id",
        F.col("since").alias("_since"),
        F.col("until").alias("_until"),
        F.explode(F.sequence(slot(F.col("since")), slot(F.col("until")))).alias("_slot"),
    )
    at = F.col(cursor).cast("timestamp")
    out = (
        df.withColumn("_slot", slot(F.col(cursor)))
        .join(spread, "_slot")
        .where((at > F.col("_since")) & (at <= F.col("_until")))
        .drop("_slot", "_since", "_until")
    )
    return out.repartition(partitions, "window_id", cursor) if partitions else out


def scan_deletes(tombstones: DataFrame, cursor: str, since: Any = None, until: Any = None) -> DataFrame:
    return scan_incremental(tombstones, cursor, since, until)


def scan_archived_as_deletes(
    df: DataFrame, cursor: str, archived: str = "archived", archived_at: str = "archivedAt", since: Any = None
) -> DataFrame:
    """Archived rows as deletes; the archive time takes the place of the cursor."""
    moved = df.where(F.col(archived)).withColumn(cursor, F.coalesce(F.col(archived_at), F.col(cursor)))
    return scan_incremental(moved, cursor, since)


def history_entries(hist: DataFrame, field: str) -> DataFrame:
    """``history_id, id, thread_id`` of each message entry of a change log."""
    return hist.select(
        F.col("id").try_cast("bigint").alias("history_id"), F.explode(field).alias("entry")
    ).select("history_id", F.col("entry.message.id").alias("id"), F.col("entry.message.threadId").alias("thread_id"))


def history_deletes(hist: DataFrame, level: str = "message") -> DataFrame:
    """Ids deleted in a change log, first report wins; per message or per thread."""
    entries = history_entries(hist, "messagesDeleted").where(F.col("id").isNotNull())
    if level == "thread":
        return (
            entries.where(F.col("thread_id").isNotNull())
            .groupBy(F.col("thread_id").alias("id"))
            .agg(F.min("history_id").alias("history_id"))
        )
    return entries.groupBy("id").agg(
        # at equal history the thread that sorts first
        F.min(F.struct("history_id", "thread_id")).alias("first")
    ).select("id", "first.thread_id", "first.history_id")


def history_added(hist: DataFrame, since: int) -> DataFrame:
    """Distinct ids added after a numeric history id."""
    newer = hist.where(F.col("id").try_cast("bigint") > since)
    return history_entries(newer, "messagesAdded").where(F.col("id").isNotNull()).select("id").distinct()


def delta_feed(df: DataFrame, removed: str, key: str, context: list[str] = ()) -> DataFrame:
    """A delta feed with ``_deleted``; a removed entry keeps only its key and context."""
    keep = {key, *context}
    gone = F.coalesce(F.col(removed), F.lit(False))
    cols = [
        F.col(c) if c in keep else F.when(~gone, F.col(c)).alias(c) for c in df.columns if c != removed
    ]
    return df.select(*cols, gone.alias("_deleted"))


def parse_jsonl(lines: DataFrame, schema: T.StructType | str, value: str = "value") -> DataFrame:
    """Text lines as typed rows; a line that is not a record keeps its text in ``_corrupt``."""
    fields = schema.simpleString()[7:-1] if isinstance(schema, T.StructType) else schema
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(F.col(value), f"{fields}, {CORRUPT} string", options)
    return lines.where(F.trim(value) != "").select(parsed.alias("r")).select("r.*")


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """Line JSON files: the good rows, and a one-row frame with the number of bad lines."""
    parsed = parse_jsonl(spark.read.text(path), schema)
    bad = parsed.agg(F.count_if(F.col(CORRUPT).isNotNull()).alias("bad_lines"))
    return parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT), bad


def report_names(raw: list[str]) -> list[str]:
    """Report headers as lower_snake names without a byte order mark."""
    clean = [re.sub(r"[^a-z0-9]+", "_", n.replace("\ufeff", "").strip().lower()).strip("_") for n in raw]
    return [n or f"_col{i}" for i, n in enumerate(clean)]


def csv_report_columns(df: DataFrame) -> DataFrame:
    """Text columns of a report under lower_snake names, empty text as null."""
    out = df.toDF(*report_names(df.columns))
    return out.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in out.columns])


def read_csv_report(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A CSV report; every column is text.

    Files are split by size. With ``multi_line`` quoted values may hold line
    breaks, and each file is read by one task.
    """
    raw = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').csv(path)
    return csv_report_columns(raw)


def unwrap_records(df: DataFrame, raw: str = "raw", key: str | None = None) -> DataFrame:
    """One row (a VARIANT ``record``) per object in the record array of an envelope.

    The array is the body itself, the named key, a known key, or else (without a
    named key) the longest top-level array that holds only objects.
    """
    keep = [c for c in df.columns if c != raw]
    as_list = lambda v: F.try_variant_get(v, "$", "array<variant>")
    opened = df.select(*keep, F.try_parse_json(F.col(raw)).alias("_body")).select(
        *keep, as_list(F.col("_body")).alias("_whole"), F.try_variant_get("_body", "$", "map<string,variant>").alias("_map")
    )
    hints = [key, *(h for h in ENVELOPE_HINTS if h != key)] if key else ENVELOPE_HINTS
    found = [as_list(F.try_element_at(F.col("_map"), F.lit(h))) for h in hints]
    if not key:
        is_object = lambda x: F.schema_of_variant(x).startswith("OBJECT")
        lists = F.transform(F.map_values("_map"), as_list)
        usable = F.filter(lists, lambda a: a.isNotNull() & (F.size(a) > 0) & F.forall(a, is_object))
        found.append(
            F.reduce(
                usable,
                F.lit(None).cast("array<variant>"),
                lambda best, a: F.when(best.isNull() | (F.size(a) > F.size(best)), a).otherwise(best),
            )
        )
    rows = opened.select(*keep, F.coalesce("_whole", *found).alias("_records"))
    return rows.select(*keep, F.explode("_records").alias("record")).where(
        F.schema_of_variant("record").startswith("OBJECT")
    )


def sheet_to_table(df: DataFrame, order: str = "row_index", values: str = "values", raw: bool = False) -> DataFrame:
    """Cells of a sheet as a table: the first row names the columns, short rows are padded."""
    if raw:
        return df.select(order, values)
    from tidemark.operators.reshape import sanitized_names

    head = df.orderBy(order).select(order, values).first()
    if head is None or not head[values]:
        return df.select(order).where(F.lit(False))
    names = sanitized_names(head[values])
    cells = [F.coalesce(F.get(values, F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)]
    return df.where(F.col(order) > head[order]).select(order, *cells)


def list_documents(
    df: DataFrame, kind_col: str, kind: str, newest: str, content: DataFrame | None = None, key: str | None = None
) -> DataFrame:
    """Documents of one kind, newest first, with their text if asked for."""
    out = df.where(F.col(kind_col) == kind)
    if content is not None:
        out = out.join(content, key, "left")
    return out.orderBy(F.col(newest).desc())
