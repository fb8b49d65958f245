"""Structured Streaming runs: drain what is there, apply it, stop.

The file source lists what exists at start and replays the same files after a
failure, so a batch is the same each time it is tried.  Targets skip a batch
of the same query that they already hold.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.scan import scan_partitioned
from tidemark.plans import apply as A
from tidemark.plans.logtable import LogTarget
from tidemark.plans.target import AppendTarget, Target


def stream_landing(
    spark: SparkSession, path: str, schema: T.StructType | str, max_files: int | None = None, fmt: str = "parquet", **options: str
) -> DataFrame:
    """A landing folder as a stream under its declared schema; ``options`` are the reader's."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def run_available_now(stream: DataFrame, apply_fn: Callable[[DataFrame, int], Any], checkpoint: str) -> int:
    """Feed all data present at start through ``apply_fn(batch, batch_id)``; the last batch id or -1."""
    seen = [-1]

    def step(batch: DataFrame, batch_id: int) -> None:
        apply_fn(batch, batch_id)
        seen[0] = batch_id

    query = (
        stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return seen[0]


def query_id(batch: DataFrame) -> str:
    """Id of the streaming query that delivers a batch: it belongs to the checkpoint. Empty outside a stream."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""


def upsert_flow(
    target: Target | LogTarget, keys: Sequence[str], seq: Sequence[str], scd: int = 1, flow: str = "upsert", merge: str = "shuffle"
) -> Callable[[DataFrame, int], None]:
    """Batch function that upserts into a keyed target; a log target takes keys, sequence and history from its own settings."""
    return _change_flow(target, keys, seq, scd, flow, merge, deletes=False)


def delete_flow(
    target: Target | LogTarget, keys: Sequence[str], seq: Sequence[str], scd: int = 1, flow: str = "delete", merge: str = "shuffle"
) -> Callable[[DataFrame, int], None]:
    """Batch function that applies tombstones; may share a target with an upsert flow."""
    return _change_flow(target, keys, seq, scd, flow, merge, deletes=True)


def _change_flow(target: Target | LogTarget, keys, seq, scd: int, flow: str, merge: str, deletes: bool):
    as_rows = lambda batch: batch.select(*keys, *seq).withColumn(A.DELETED, F.lit(True)) if deletes else A.as_changes(batch)
    if isinstance(target, LogTarget):
        return lambda batch, batch_id: target.apply(as_rows(batch), flow, batch_id, query_id(batch))
    target.keys = target.keys or list(keys)

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = as_rows(batch)

        def build(state: DataFrame | None) -> DataFrame:
            if scd == 2:
                return A.scd2_state(rows, keys, seq) if state is None else A.apply_changes_scd2(state, rows, keys, seq)
            if state is None:
                return A.winners(rows, keys, seq)
            missing = [c for c in rows.columns if c not in state.columns]
            base = state
            for c in missing:
                base = base.withColumn(c, F.lit(None).cast(rows.schema[c].dataType))
            return A.apply_changes_scd1(base, rows, keys, seq, merge)

        target.apply(flow, batch_id, build, rows, query_id(batch))

    return step


def append_flow(target: AppendTarget, flow: str = "append") -> Callable[[DataFrame, int], None]:
    return lambda batch, batch_id: target.append(batch, flow, batch_id, query_id(batch))


def windowed_flow(
    windows: DataFrame, cursor: str, apply_fn: Callable[[DataFrame, int], None], partitions: int | None = None
) -> Callable[[DataFrame, int], None]:
    """Batch function that spreads a batch over planned windows; an empty batch plans nothing."""

    def step(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            apply_fn(scan_partitioned(batch, cursor, windows, partitions), batch_id)

    return step


def dedupe_stream(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Drop keys delivered again within the delay; state older than that is let go."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
