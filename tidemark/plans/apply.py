"""Applying changes to target tables.

A target in state form holds one row per key (type 1) or per key and sequence
(type 2) with its tombstones, so that a late older change can neither bring a
deleted key back nor overwrite a newer row.  ``current_rows`` and
``history_rows`` give what users see.

At equal sequence a delete beats an upsert; two upserts are settled by the
hash of their payload, so the outcome never depends on arrival order.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans import blocks as B

DELETED = "_deleted"
UNCHANGED = "_unchanged"
FROM = "valid_from"
TO = "valid_to"


def payload_hash(df: DataFrame, cols: Sequence[str], seed: int | None = None) -> Column:
    """Hash of the payload columns; a null counts as a value of its own. Each seed gives another hash."""
    parts: list[Column] = [] if seed is None else [F.lit(seed)]
    for c in cols:
        kind = df.schema[c].dataType.simpleString()
        parts.append(F.to_json(F.col(c)) if "map<" in kind or "variant" in kind else F.col(c))
    return F.xxhash64(*parts, *[F.col(c).isNull() for c in cols])


def _payload(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in (*keys, DELETED, UNCHANGED, FROM, TO)]


def as_changes(df: DataFrame, delete: Column | None = None) -> DataFrame:
    """Change rows with the delete flag set."""
    if DELETED in df.columns:
        return df.withColumn(DELETED, F.coalesce(F.col(DELETED), F.lit(False)))
    return df.withColumn(DELETED, F.lit(False) if delete is None else F.coalesce(delete, F.lit(False)))


def _rank(df: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> Column:
    return F.struct(*seq, DELETED, payload_hash(df, _payload(df, keys)).alias("_tie"))


def key_struct(keys: Sequence[str]) -> Column:
    """The keys as one value: never null, and equal where null keys meet, so joins and groupings share it."""
    return F.struct(*[F.col(k) for k in keys])


def winners(changes: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """One row per key: the highest sequence.  Combined on the map side."""
    return _keyed_winners(changes, keys, seq).select("_k.*", "_r.*")


def _keyed_winners(changes: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """``_k`` (the keys), ``_r`` (the other columns) and ``_rank`` of the highest sequence of each key."""
    rest = [c for c in changes.columns if c not in keys]
    ranked = changes.select(key_struct(keys).alias("_k"), F.struct(*rest).alias("_r"), _rank(changes, keys, seq).alias("_rank"))
    return ranked.groupBy("_k").agg(F.max_by("_r", "_rank").alias("_r"), F.max("_rank").alias("_rank"))


def apply_changes_scd1(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], seq: Sequence[str], merge: str = "shuffle"
) -> DataFrame:
    """Next type 1 state: per key the row with the highest sequence.

    ``shuffle`` meets both sides in one full outer join, for which the batch is
    already dealt by its grouping.  ``probe`` suits a small batch: the target streams
    through a join that AQE broadcasts once the batch is measured to be small, and is
    not shuffled.
    """
    if merge not in ("shuffle", "probe"):
        raise ValueError(f"unknown merge {merge!r}")
    old, changes = as_changes(target), as_changes(changes)
    cols = old.columns
    fit = [F.col(c) if c in changes.columns else F.lit(None).cast(old.schema[c].dataType).alias(c) for c in cols]
    right = _keyed_winners(changes.select(*fit), keys, seq).toDF("_k2", "_new", "_new_rank")
    rest = [c for c in cols if c not in keys]
    left = old.select(key_struct(keys).alias("_k"), F.struct(*rest).alias("_old"), _rank(old, keys, seq).alias("_old_rank"))
    newer = F.col("_old").isNull() | (F.col("_new").isNotNull() & (F.col("_new_rank") > F.col("_old_rank")))
    row = F.when(newer, F.col("_new")).otherwise(F.col("_old")).alias("_r")
    match = F.col("_k") == F.col("_k2")
    if merge == "shuffle":
        joined = left.join(right, match, "full_outer")
        return joined.select(F.coalesce("_k", "_k2").alias("_k"), row).select("_k.*", "_r.*").select(*cols)
    kept = left.join(right, match, "left").select("_k", row).select("_k.*", "_r.*")
    known = left.select("_k").join(right.select("_k2"), match, "left_semi")
    fresh = right.join(known, match, "left_anti").select("_k2.*", "_new.*")
    return kept.select(*cols).unionByName(fresh.select(*cols))


def same_key(keys: Sequence[str]) -> Column:
    """Equality with the columns ``_k_<key>``; a null is a value like any other."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return cond


def keys_of(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of ``df``, each once, as ``_k_<key>``."""
    return df.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()


def current_rows(state: DataFrame) -> DataFrame:
    """What users see of a type 1 state."""
    return state.where(~F.col(DELETED)).drop(DELETED)


def scd2_state(rows: DataFrame, keys: Sequence[str], seq: Sequence[str], split: B.Split | None = None) -> DataFrame:
    """Version rows of ``rows``: validity, unchanged rows and tombstones flagged.

    A row whose payload equals the row before it opens no version; it is kept
    as ``_unchanged``, since a late row may come between the two.
    """
    cols = [c for c in rows.columns if c not in (FROM, TO, UNCHANGED)]
    rows = as_changes(rows.select(*cols))
    payload = [c for c in _payload(rows, keys) if c not in seq]
    rest = [c for c in rows.columns if c not in (*keys, *seq)]
    # measured on the raw rows: a scan of key and sequence, not a run of the plan above
    split = split or B.find_split(rows, keys, seq[0])
    if split.plain:
        # one shuffle by key serves the grouping by key and sequence and the windows
        rows = rows.repartition(*keys)
    single = (
        rows.groupBy(*keys, *seq)
        .agg(F.max_by(F.struct(*rest), F.struct(DELETED, payload_hash(rows, _payload(rows, keys)).alias("_tie"))).alias("_r"))
        .select(*keys, *seq, "_r.*")
        .withColumn("_hash", payload_hash(rows, payload))
    )

    def look_back(w):
        before, gone = F.lag("_hash").over(w), F.lag(DELETED).over(w)
        both_gone = F.coalesce(gone, F.lit(True)) & F.col(DELETED)
        same = F.coalesce((before == F.col("_hash")) & ~gone & ~F.col(DELETED), F.lit(False))
        return {UNCHANGED: same | both_gone}

    flagged = B.neighbours(single, keys, seq, look_back, after=False, split=split)
    if split.plain:
        # same keys and order as the window before, so no further shuffle or sort
        by, order = ", ".join(f"`{k}`" for k in keys), ", ".join(f"`{s}`" for s in seq)
        ahead = F.expr(f"lead(_opens) IGNORE NULLS OVER (PARTITION BY {by} ORDER BY {order})")
        opens = F.when(~F.col(UNCHANGED), F.col(seq[0]))
        state = flagged.withColumn("_opens", opens).withColumn(TO, ahead)
        state = state.withColumn(TO, F.when(~F.col(UNCHANGED), F.col(TO))).drop("_opens")
    else:
        opened = flagged.where(~F.col(UNCHANGED))
        ahead = B.neighbours(opened, keys, seq, lambda w: {TO: F.lead(seq[0]).over(w)}, before=False, split=split)
        silent = flagged.where(F.col(UNCHANGED)).withColumn(TO, F.lit(None).cast(single.schema[seq[0]].dataType))
        state = ahead.unionByName(silent)
    return state.withColumn(FROM, F.col(seq[0])).drop("_hash")


def history_rows(state: DataFrame) -> DataFrame:
    """What users see of a type 2 state: real versions with ``valid_from`` and ``valid_to``."""
    return state.where(~F.col(DELETED) & ~F.col(UNCHANGED)).drop(DELETED, UNCHANGED)


def apply_changes_scd2(
    state: DataFrame, changes: DataFrame, keys: Sequence[str], seq: Sequence[str], split: B.Split | None = None
) -> DataFrame:
    """Next type 2 state: only keys that occur in the batch are worked out again."""
    changes = as_changes(changes)
    touched, match = keys_of(changes, keys), same_key(keys)
    base = [c for c in state.columns if c not in (FROM, TO, UNCHANGED)]
    affected = state.join(touched, match, "left_semi").select(*base)
    redone = scd2_state(affected.unionByName(changes, allowMissingColumns=True), keys, seq, split)
    return state.join(touched, match, "left_anti").unionByName(redone)


def scd2_intervals(changes: DataFrame, keys: Sequence[str], seq: Sequence[str], split: B.Split | None = None) -> DataFrame:
    """Start and end of validity of every change row, in order within its key."""
    return B.neighbours(
        changes, keys, seq, lambda w: {FROM: F.col(seq[0]), TO: F.lead(seq[0]).over(w)}, before=False, split=split
    )


def apply_deletes(
    state: DataFrame, tombstones: DataFrame, keys: Sequence[str], seq: Sequence[str], scd: int = 1, merge: str = "shuffle"
) -> DataFrame:
    """Tombstones into a state: type 1 hides the key unless a newer row exists, type 2 closes the open row."""
    gone = tombstones.select(*keys, *seq).withColumn(DELETED, F.lit(True))
    if scd == 1:
        return apply_changes_scd1(state, gone, keys, seq, merge)
    return apply_changes_scd2(state, gone, keys, seq)


def snapshot_changes(target: DataFrame, snap: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New, changed and vanished rows between the current rows and a full snapshot.

    One full outer join; unchanged rows drop out.  ``change`` is ``insert``,
    ``update`` or ``delete``; a delete carries the last known payload.
    """
    cols = snap.columns
    rest = [c for c in cols if c not in keys]
    old = target.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.struct(*rest).alias("_old"), payload_hash(target, rest).alias("_h1"))
    new = snap.select(*keys, F.struct(*rest).alias("_new"), payload_hash(snap, rest).alias("_h2"))
    joined = new.join(old, same_key(keys), "full_outer")
    change = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(F.col("_h1") != F.col("_h2"), "update")
    )
    return (
        joined.select(
            *[F.coalesce(F.col(k), F.col(f"_k_{k}")).alias(k) for k in keys],
            F.coalesce("_new", "_old").alias("_r"),
            change.alias("change"),
        )
        .where(F.col("change").isNotNull())
        .select(*keys, "_r.*", "change")
    )


def apply_snapshot(
    target: DataFrame, snap: DataFrame, keys: Sequence[str], version: Any = None, scd: int = 1
) -> DataFrame:
    """A full snapshot into a target.

    Type 1: the snapshot is the new content.  Type 2: ``target`` is a history
    with ``valid_from``/``valid_to``; changed and vanished rows are closed at
    ``version``, new and changed ones opened.
    """
    if scd == 1:
        return snap
    kind = target.schema[FROM].dataType
    at = (version if isinstance(version, Column) else F.lit(version)).cast(kind)
    closed = target.where(F.col(TO).isNotNull())
    live = target.where(F.col(TO).isNull())
    moved = snapshot_changes(live.drop(FROM, TO), snap, keys)
    ended = moved.where(F.col("change") != "insert").select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.lit(True).alias("_end"))
    old = live.join(ended, same_key(keys), "left")
    old = old.withColumn(TO, F.when(F.col("_end"), at).cast(kind)).select(*target.columns)
    opened = moved.where(F.col("change") != "delete").drop("change")
    opened = opened.withColumn(FROM, at).withColumn(TO, F.lit(None).cast(kind)).select(*target.columns)
    return closed.unionByName(old).unionByName(opened)


def apply_append(target: DataFrame, df: DataFrame) -> DataFrame:
    return target.unionByName(df, allowMissingColumns=True)


def apply_flagged(
    state: DataFrame, df: DataFrame, keys: Sequence[str], seq: Sequence[str], flag: str, merge: str = "shuffle"
) -> DataFrame:
    """Rows whose flag is set are deletes, the others upserts; one pass."""
    changes = df.withColumn(DELETED, F.coalesce(F.col(flag), F.lit(False)))
    return apply_changes_scd1(state, changes if flag == DELETED else changes.drop(flag), keys, seq, merge)


def upsert_current_state(state: DataFrame, df: DataFrame, keys: Sequence[str], rev: str, merge: str = "shuffle") -> DataFrame:
    """Full listing of a source without a modified time: the revision decides."""
    return apply_changes_scd1(state, df, keys, [rev], merge)


def write_back(df: DataFrame, keys: Sequence[str], cursor: str, op: str, start: Any) -> DataFrame:
    """Change rows for writes to a keyed table.

    ``op`` holds ``insert``, ``update`` or ``delete``.  Every change gets a
    cursor after ``start``; a tombstone keeps only its key and cursor.
    """
    gone = F.lower(F.col(op)) == "delete"
    kind = df.schema[cursor].dataType
    moved = F.greatest(F.col(cursor), F.lit(start).cast(kind) + F.make_dt_interval(secs=F.lit(1).cast("decimal(18,6)")))
    cols = []
    for f in df.schema:
        if f.name == op:
            continue
        if f.name in keys:
            cols.append(F.col(f.name))
        elif f.name == cursor:
            cols.append(moved.cast(kind).alias(cursor))
        else:
            cols.append(F.when(~gone, F.col(f.name)).alias(f.name))
    return df.select(*cols, gone.alias(DELETED))


def empty_state(schema: T.StructType, spark, scd: int = 1, seq_type: T.DataType | None = None) -> DataFrame:
    fields = [*schema.fields, T.StructField(DELETED, T.BooleanType())]
    if scd == 2:
        kind = seq_type or T.TimestampType()
        fields += [T.StructField(UNCHANGED, T.BooleanType()), T.StructField(TO, kind), T.StructField(FROM, kind)]
    return spark.createDataFrame([], T.StructType(fields))
