"""Run a list of tables from landing folders into targets.

The spec names the tables and their options; keys, cursor and ingestion type
come from a metadata frame unless the spec overrides them.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans import apply as A
from tidemark.plans.logtable import LogTarget
from tidemark.plans.target import AppendTarget, Target, folder_names
from tidemark.streaming import runs

# Options that steer the target and never reach the source.
RESERVED = ("scd_type", "primary_keys", "sequence_by", "cluster_by")
SCD_TYPES = ("SCD_TYPE_1", "SCD_TYPE_2", "APPEND_ONLY")
_TABLE_KEYS = ("source_table", "destination_catalog", "destination_schema", "destination_table", "table_configuration")


@dataclass
class TablePlan:
    """Everything needed to run one table."""

    source: str
    destination: str
    options: dict[str, str]
    keys: list[str] = field(default_factory=list)
    sequence_by: str | None = None
    ingestion_type: str = "cdc"
    scd: int = 1
    cluster_by: list[str] = field(default_factory=list)


def _only(mapping: dict, allowed: tuple[str, ...], where: str) -> None:
    unknown = set(mapping) - set(allowed)
    if unknown:
        raise ValueError(f"unknown keys in {where}: {sorted(unknown)}")


def _as_list(value: str | list | None) -> list[str]:
    if not value:
        return []
    if isinstance(value, list):
        return [str(v) for v in value]
    text = value.strip()
    return [str(v) for v in json.loads(text)] if text.startswith("[") else [v.strip() for v in text.split(",") if v.strip()]


def table_plans(spec: dict[str, Any], metadata: dict[str, dict[str, Any]]) -> list[TablePlan]:
    """Check the spec and settle keys, sequence, ingestion type and history per table."""
    _only(spec, ("connection_name", "objects"), "spec")
    if not str(spec.get("connection_name") or "").strip():
        raise ValueError("connection_name must be a non-empty string")
    if not spec.get("objects"):
        raise ValueError("objects must be a non-empty list")
    plans = []
    for entry in spec["objects"]:
        _only(entry, ("table",), "object")
        table = entry["table"]
        _only(table, _TABLE_KEYS, "table")
        name = table["source_table"]
        config = {
            str(k): json.dumps(v) if isinstance(v, (dict, list)) else str(v)
            for k, v in (table.get("table_configuration") or {}).items()
        }
        known = metadata.get(name, {})
        scd_type = config.get("scd_type", "SCD_TYPE_1").upper()
        if scd_type not in SCD_TYPES:
            raise ValueError(f"invalid scd_type {scd_type!r}")
        kind = "append" if scd_type == "APPEND_ONLY" else known.get("ingestion_type") or "cdc"
        place = [table.get(k) for k in ("destination_catalog", "destination_schema")]
        plans.append(
            TablePlan(
                source=name,
                destination="/".join([*[p for p in place if p], table.get("destination_table") or name]),
                options={k: v for k, v in config.items() if k not in RESERVED},
                keys=_as_list(config.get("primary_keys")) or list(known.get("primary_keys") or []),
                sequence_by=config.get("sequence_by") or known.get("cursor_field"),
                ingestion_type=kind,
                scd=2 if scd_type == "SCD_TYPE_2" else 1,
                cluster_by=_as_list(config.get("cluster_by")),
            )
        )
    return plans


def _metadata(frame: DataFrame, names: list[str]) -> dict[str, dict[str, Any]]:
    # one row per table of the spec, or one more that shows a name to be ambiguous
    rows = frame.where(F.col("tableName").isin(*names)).dropDuplicates().limit(len(names) + 1).collect()
    twice = sorted({r["tableName"] for r in rows if sum(x["tableName"] == r["tableName"] for x in rows) > 1})
    if twice:
        raise ValueError(f"metadata describes {twice} more than once")
    return {r["tableName"]: r.asDict() for r in rows}


def ingest(
    spark: SparkSession,
    spec: dict[str, Any],
    metadata: DataFrame,
    schemas: dict[str, T.StructType | str],
    landing: str,
    out: str,
    fmt: str = "parquet",
    version: Any = None,
) -> list[TablePlan]:
    """Drain every table of the spec into its target and return what was run.

    Landing data of a table lies in ``landing/<table>``, its tombstones in
    ``landing/<table>__deletes``.
    """
    names = [e["table"]["source_table"] for e in spec.get("objects") or []]
    plans = table_plans(spec, _metadata(metadata, names))
    for plan in plans:
        _run_table(spark, plan, schemas[plan.source], landing, out, fmt, version)
    return plans


def _run_table(spark, plan: TablePlan, schema, landing: str, out: str, fmt: str, version: Any) -> None:
    source, dest = f"{landing}/{plan.source}", f"{out}/{plan.destination}"
    files = int(plan.options["max_files_per_batch"]) if "max_files_per_batch" in plan.options else None
    if plan.ingestion_type == "append":
        stream = runs.stream_landing(spark, source, schema, files, fmt)
        runs.run_available_now(stream, runs.append_flow(AppendTarget(spark, f"{dest}/data")), f"{dest}/checkpoint/append")
        return
    if plan.ingestion_type == "snapshot":
        target = Target(spark, dest, plan.cluster_by, plan.keys)
        run_snapshot(target, spark.read.format(fmt).schema(schema).load(source), plan.keys, plan.scd, version)
        return
    if not plan.sequence_by or not plan.keys:
        raise ValueError(f"table {plan.source} needs keys and a sequence column")
    seq = [plan.sequence_by]
    target = LogTarget(spark, dest, plan.keys, seq, plan.scd, plan.cluster_by)
    stream = runs.stream_landing(spark, source, schema, files, fmt)
    runs.run_available_now(stream, runs.upsert_flow(target, plan.keys, seq, plan.scd), f"{dest}/checkpoint/upsert")
    if plan.ingestion_type == "cdc_with_deletes" and folder_names(spark, f"{source}__deletes"):
        gone = runs.stream_landing(spark, f"{source}__deletes", schema, files, fmt)
        runs.run_available_now(gone, runs.delete_flow(target, plan.keys, seq, plan.scd), f"{dest}/checkpoint/delete")


def run_snapshot(target: Target, snap: DataFrame, keys: Sequence[str], scd: int = 1, version: Any = None) -> None:
    """A full snapshot becomes the target's rows (type 1) or closes and opens versions (type 2)."""
    at = F.lit(version).cast("timestamp") if version is not None else F.current_timestamp()

    def build(state: DataFrame | None) -> DataFrame:
        if scd == 1:
            return snap
        if state is None:
            return snap.withColumn(A.FROM, at).withColumn(A.TO, F.lit(None).cast("timestamp"))
        return A.apply_snapshot(state, snap, keys, at, scd=2)

    last = target.head().flows.get("snapshot", ["", -1])
    target.apply("snapshot", last[1] + 1, build)
