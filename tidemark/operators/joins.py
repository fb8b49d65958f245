"""Fan-outs, look-ups and tree walks.

Plain equi-joins leave the strategy to Spark: AQE broadcasts a side only once
its measured size is below the threshold, and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.forest import tree_walk  # noqa: F401
from tidemark.plans.apply import payload_hash, same_key


def fan_out(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, context: Sequence[str] = ()) -> DataFrame:
    """Each child under its parent, with the parent's context columns."""
    side = parents.select(F.col(parent_key).alias("_parent"), *context)
    return children.join(side, F.col(child_key) == F.col("_parent")).drop("_parent")


def changed_parent_children(
    parents: DataFrame, children: DataFrame, parent_key: str, child_key: str,
    parent_cursor: str, since: Any, child_cursor: str | None = None,
) -> DataFrame:
    """Children of parents changed after the mark, then newer than it themselves."""
    mark = lambda df, c: F.lit(since).cast(df.schema[c].dataType)
    changed = parents.where(F.col(parent_cursor) > mark(parents, parent_cursor))
    if child_cursor:
        children = children.where(F.col(child_cursor) > mark(children, child_cursor))
    return children.join(changed.select(F.col(parent_key).alias(child_key)), child_key, "left_semi")


def by_ids(df: DataFrame, key: str, ids: DataFrame | Sequence[Any] | None = None, first: int | None = None) -> DataFrame:
    """Rows of an explicit id list, else the first ``first`` by key, else all."""
    if isinstance(ids, DataFrame):
        return df.join(ids.select(F.col(ids.columns[0]).alias(key)), key, "left_semi")
    if ids:
        return df.where(F.col(key).isin(*ids))
    return df.orderBy(key).limit(first) if first else df


def junction(parents: DataFrame, links: DataFrame, related: DataFrame, parent_key: str, related_key: str) -> DataFrame:
    """Many-to-many rows with a synthetic id ``parent_related``."""
    joined = links.join(parents.select(parent_key), parent_key).join(related, related_key)
    return joined.withColumn(
        "junction_id", F.concat_ws("_", F.col(parent_key).cast("string"), F.col(related_key).cast("string"))
    )


def inherit(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, cols: dict[str, str]) -> DataFrame:
    """Fill missing child fields from the parent (``child column -> parent column``)."""
    side = parent.select(F.col(parent_key).alias("_pk"), *[F.col(p).alias(f"_p_{c}") for c, p in cols.items()])
    out = child.join(side, F.col(child_key) == F.col("_pk"), "left")
    filled = {c: F.coalesce(F.col(c), F.col(f"_p_{c}")) if c in child.columns else F.col(f"_p_{c}") for c in cols}
    return out.withColumns(filled).drop("_pk", *[f"_p_{c}" for c in cols])


def attach_lookup(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str, out: str) -> DataFrame:
    """The matching look-up record as one struct column, null where there is none."""
    value = F.struct(*[c for c in lookup.columns if c != lookup_key])
    side = lookup.select(F.col(lookup_key).alias("_lk"), value.alias(out))
    return df.join(side, F.col(key) == F.col("_lk"), "left").drop("_lk")


def messages_per_channel(
    messages: DataFrame, teams: DataFrame, channels: DataFrame, limit: int = 20
) -> DataFrame:
    """Message counts per team and channel name.

    Counted per id before the look-ups, so only one row per channel is joined.
    Inputs: messages(team_id, channel_id, created, modified), teams and
    channels(id, display_name).
    """
    counted = messages.groupBy("team_id", "channel_id").agg(
        F.count("*").alias("n"), F.max("modified").alias("latest"), F.min("created").alias("oldest")
    )
    named = counted.join(
        teams.select(F.col("id").alias("team_id"), F.col("display_name").alias("team_name")), "team_id", "left"
    ).join(
        channels.select(F.col("id").alias("channel_id"), F.col("display_name").alias("channel_name")),
        "channel_id",
        "left",
    )
    return (
        named.groupBy("team_name", "channel_name")
        .agg(
            F.sum("n").alias("message_count"),
            F.max("latest").alias("latest_message"),
            F.min("oldest").alias("oldest_message"),
        )
        .orderBy(F.desc("message_count"), "team_name", "channel_name")
        .limit(limit)
    )


def messages_with_replies(messages: DataFrame, replies: DataFrame, limit: int = 10) -> DataFrame:
    """Most answered messages.  Inputs: messages(id, subject, content, created),
    replies(parent_id, modified).  Replies are counted before the join."""
    counted = replies.groupBy("parent_id").agg(
        F.count("*").alias("reply_count"), F.max("modified").alias("latest_reply")
    )
    return (
        messages.join(counted, F.col("id") == F.col("parent_id"))
        .select(
            F.col("id").alias("message_id"),
            "subject",
            F.substring("content", 1, 80).alias("message_content"),
            "reply_count",
            "created",
            "latest_reply",
        )
        .orderBy(F.desc("reply_count"), F.desc("latest_reply"), "message_id")
        .limit(limit)
    )


def referenced_elements(frames: DataFrame, refs: DataFrame) -> DataFrame:
    """Primary element of each frame plus its other references.

    Inputs: frames(frame_id, primary_id, start_time, end_time), refs(frame_id, element_id).
    """
    known = frames.where(F.col("frame_id").isNotNull())
    primary = known.where(F.col("primary_id").isNotNull()).select(
        "frame_id", F.col("primary_id").alias("element_id"), F.lit("primary").alias("relationship_type"),
        "start_time", "end_time",
    )
    others = (
        refs.where(F.col("element_id").isNotNull())
        .join(known, "frame_id")
        .where(~F.col("element_id").eqNullSafe(F.col("primary_id")))
        .select("frame_id", "element_id", F.lit("referenced").alias("relationship_type"), "start_time", "end_time")
    )
    return primary.unionByName(others)


def cohort_members(cohorts: DataFrame, profiles: DataFrame, cohort_id: str, condition_cols: Sequence[str], member_id: str) -> DataFrame:
    """Membership pairs of cohorts and profiles that share the condition columns."""
    return (
        profiles.where(F.col(member_id).isNotNull())
        .join(cohorts.where(F.col(cohort_id).isNotNull()), list(condition_cols))
        .select(cohort_id, member_id)
    )


def per_key_since(df: DataFrame, marks: DataFrame, key: str, cursor: str, mark: str = "watermark") -> DataFrame:
    """Rows newer than their own entity's watermark; an entity without one is read in full."""
    side = marks.select(F.col(key).alias("_mk"), F.col(mark).alias("_mark"))
    joined = df.join(side, F.col(key) == F.col("_mk"), "left")
    return joined.where(F.col("_mark").isNull() | (F.col(cursor) > F.col("_mark"))).drop("_mk", "_mark")


def snapshot_anti(target: DataFrame, snap: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is gone from the newest snapshot; a null key equals a null key."""
    return target.join(snap.select(*[F.col(k).alias(f"_k_{k}") for k in keys]), same_key(keys), "left_anti")


def latest_at(df: DataFrame, key: Sequence[str], ts: str, when: Any, exact: bool = False) -> DataFrame:
    """Last row of each key at or before ``when`` (or exactly at it)."""
    at: Column = F.lit(when).cast(df.schema[ts].dataType)
    inside = df.where(F.col(ts) == at if exact else F.col(ts) <= at)
    order = F.struct(ts, payload_hash(df, df.columns).alias("_tie"))
    return inside.groupBy(*key).agg(F.max_by(F.struct(*df.columns), order).alias("r")).select("r.*")
