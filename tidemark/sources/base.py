"""A job: how one landed raw table becomes a target table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.ingest import run_snapshot
from tidemark.plans.logtable import LogTarget
from tidemark.plans.target import AppendTarget, Target, folder_names
from tidemark.streaming import runs


@dataclass(frozen=True)
class Job:
    """One table of a source family.

    ``landing`` is the declared schema of the raw files of format ``fmt``, ``shape``
    turns a raw frame into rows of the target, ``shape_deletes`` one of tombstones
    into keys and cursor (by default as ``shape`` does). ``options`` go to the reader.
    """

    name: str
    landing: str
    shape: Callable[[DataFrame], DataFrame]
    keys: Sequence[str] = ()
    cursor: str | None = None
    ingestion_type: str = "cdc"
    options: dict = field(default_factory=dict)
    fmt: str = "json"
    shape_deletes: Callable[[DataFrame], DataFrame] | None = None


def metadata(spark: SparkSession, jobs: Sequence[Job]) -> DataFrame:
    """Metadata rows of a family."""
    rows = [(j.name, list(j.keys), j.cursor, j.ingestion_type) for j in jobs]
    return spark.createDataFrame(
        rows, "tableName string, primary_keys array<string>, cursor_field string, ingestion_type string"
    )


def run(spark: SparkSession, job: Job, landing: str, out: str, scd: int = 1) -> DataFrame:
    """Drain the landing folder of one job into its target and return its state.

    Tombstones of a ``cdc_with_deletes`` job lie in ``<landing>__deletes``; they are applied after the upserts by a flow of their own.
    """
    fmt = job.fmt
    if job.ingestion_type == "snapshot":
        target = Target(spark, out, keys=job.keys)
        run_snapshot(target, job.shape(spark.read.format(fmt).schema(job.landing).options(**job.options).load(landing)), job.keys, scd)
        return target.state()
    stream = job.shape(runs.stream_landing(spark, landing, job.landing, fmt=fmt, **job.options))
    if job.ingestion_type == "append":
        sink = AppendTarget(spark, f"{out}/data")
        runs.run_available_now(stream, runs.append_flow(sink), f"{out}/checkpoint")
        return sink.read()
    target = LogTarget(spark, out, job.keys, [job.cursor], scd)
    runs.run_available_now(stream, runs.upsert_flow(target, job.keys, [job.cursor], scd), f"{out}/checkpoint")
    if job.ingestion_type == "cdc_with_deletes" and folder_names(spark, f"{landing}__deletes"):
        gone = (job.shape_deletes or job.shape)(runs.stream_landing(spark, f"{landing}__deletes", job.landing, fmt=fmt, **job.options))
        runs.run_available_now(gone, runs.delete_flow(target, job.keys, [job.cursor], scd), f"{out}/checkpoint_deletes")
    return target.state()


def raw_json(df: DataFrame) -> DataFrame:
    """Typed rows as raw JSON records, the form landing jobs read."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("raw"))


