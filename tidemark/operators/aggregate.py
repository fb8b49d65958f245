"""Grouping, de-duplication and cursor aggregates, all with map-side combine."""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans import blocks as B
from tidemark.plans.apply import payload_hash

# Natural key columns, tried in this order.
KEY_HINTS = ("id", "sha", "uuid", "node_id", "name")


def types_catalog(points: DataFrame, descriptor: str, unit: str) -> DataFrame:
    """First word of the descriptor and the unit, counted, most frequent first."""
    word = F.split(F.trim(F.coalesce(descriptor, F.lit(""))), " ")[0]
    return (
        points.groupBy(
            F.when(word == "", "Unknown").otherwise(word).alias("point_type"),
            F.trim(F.coalesce(unit, F.lit(""))).alias("engineering_units"),
        )
        .agg(F.count("*").alias("count_points"))
        .orderBy(F.desc("count_points"), "point_type", "engineering_units")
    )


def survey_rollups(answers: DataFrame, question: str, choice: str) -> DataFrame:
    """Counts per question and choice, with the question total and share."""
    counts = answers.groupBy(question, choice).agg(F.count("*").alias("answers"))
    totals = counts.groupBy(F.col(question).alias("_q")).agg(F.sum("answers").alias("question_total"))
    return (
        counts.join(totals, F.col(question).eqNullSafe(F.col("_q")))
        .drop("_q")
        .withColumn("share", F.col("answers") / F.col("question_total"))
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counted = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted).orderBy("table_name")


def max_cursor(df: DataFrame, cursor: str, cap: Any = None) -> DataFrame:
    """Lowest and highest cursor, the highest no later than ``cap``."""
    high = F.max(cursor)
    if cap is not None:
        high = F.least(high, F.lit(cap).cast(df.schema[cursor].dataType))
    return df.agg(F.min(cursor).alias("min_cursor"), high.alias("max_cursor"))


def max_cursor_by(df: DataFrame, key: str, cursor: str, previous: DataFrame | None = None) -> DataFrame:
    """Watermark per entity, never behind the previous one; idle entities keep theirs."""
    new = df.groupBy(key).agg(F.max(cursor).alias("watermark"))
    if previous is None:
        return new
    old = previous.select(F.col(key).alias("_k"), F.col("watermark").alias("_old"))
    return new.join(old, F.col(key) == F.col("_k"), "full_outer").select(
        F.coalesce(F.col(key), F.col("_k")).alias(key),
        F.greatest(F.col("watermark"), F.col("_old")).alias("watermark"),
    )


def first_cursor(df: DataFrame, cursor: str) -> DataFrame:
    return df.agg(F.min(cursor).alias("first_cursor"))


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Drop full-row duplicates; equal copies are already combined on the map side."""
    return df.dropDuplicates()


def natural_key(df: DataFrame, hints: Sequence[str] = KEY_HINTS) -> Column:
    """``hint=value`` of the first hint that is set, else a hash of the record."""
    found = [F.concat(F.lit(f"{h}="), F.col(h).cast("string")) for h in hints if h in df.columns]
    whole = F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256)
    return F.coalesce(*found, whole)


def dedupe_by_key_hints(df: DataFrame, hints: Sequence[str] = KEY_HINTS) -> DataFrame:
    """One row per natural key; which copy stays is fixed by the record's own text."""
    cols = df.columns
    keyed = df.select(natural_key(df, hints).alias("_key"), F.struct(*cols).alias("_row"))
    return keyed.groupBy("_key").agg(F.min_by("_row", F.to_json("_row")).alias("_row")).select("_row.*")


def latest_per_key(df: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """Newest row of each key.  ``max_by`` combines on the map side, so a hot key is cheap.

    Rows of equal sequence are settled by the hash of their payload.
    """
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*seq, payload_hash(df, rest).alias("_tie"))
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r"))
    return best.select(*keys, "_r.*").select(*df.columns)


def balance_partitions(
    df: DataFrame, item: str, weight: str, bins: int, blocks: int | None = None
) -> DataFrame:
    """Assign items to ``bins`` of near equal weight.

    Items go along a weighted prefix sum in item order, so the bins differ by
    at most one item's weight; nothing is gathered in one place.
    """
    total = df.select(F.sum(weight).alias("t"))
    placed = B.running_position(df, [item], "_upto", F.col(weight), blocks=blocks)
    middle = F.col("_upto") - F.col(weight) / 2
    spot = F.floor(middle * bins / F.greatest(total.scalar(), F.lit(1))).cast("int")
    return placed.withColumn("bin", F.least(spot, F.lit(bins - 1))).drop("_upto")


def pour_bins(df: DataFrame, item: str, weight: str, bins: int, blocks: int | None = None) -> DataFrame:
    """Assign unique items to ``bins`` so that the fullest holds at most 4/3 of the mean and the heaviest item.

    Items above a third of the mean, ``3 * bins`` at most, are placed one by one, each
    in the least loaded bin, heaviest first. The light ones are poured: the bins are
    filled up to one level, in item order, by a running total that no task gathers.
    A null or negative weight counts as zero. Up to 4,096 bins.
    """
    if not 1 <= bins <= 4096:
        raise ValueError(f"cannot fill {bins} bins")
    load = F.greatest(F.coalesce(F.col(weight).cast("double"), F.lit(0.0)), F.lit(0.0))
    rows = df.withColumn("_load", load)
    total = rows.agg(F.sum("_load")).first()[0] or 0.0
    heavy = F.col("_load") * 3 * bins > F.lit(total)
    held = [(0.0, b) for b in range(bins)]
    placed: list[tuple] = []
    for r in sorted(rows.where(heavy).select(item, "_load").collect(), key=lambda r: (-r["_load"], str(r[item]))):
        least, b = heapq.heappop(held)
        placed.append((r[item], b))
        heapq.heappush(held, (least + r["_load"], b))
    held.sort()
    left, level = total - sum(x for x, _ in held), held[0][0]
    # the level to which what is left fills the bins
    for n, (_, _) in enumerate(held, 1):
        above = held[n][0] if n < bins else float("inf")
        if (above - level) * n >= left:
            level += left / n
            break
        left, level = left - (above - level) * n, above
    room, cuts, order = 0.0, [], [b for _, b in held]
    for x, _ in held[:-1]:
        room += max(0.0, level - x)
        cuts.append(room)
    size = 1
    while size <= len(cuts):
        size *= 2
    cuts += [float("inf")] * (size - 1 - len(cuts))
    light = B.running_position(rows.where(~heavy), [item], "_upto", F.col("_load"), blocks=blocks)
    at = F.least(B.block_of(F.col("_upto") - F.col("_load"), cuts), F.lit(bins - 1))
    poured = light.withColumn("bin", F.get(F.array(*[F.lit(b) for b in order]), at)).drop("_upto")
    known = df.sparkSession.createDataFrame(placed, T.StructType([T.StructField("_item", df.schema[item].dataType), T.StructField("bin", T.IntegerType())]))
    chosen = rows.where(heavy).join(known, F.col(item) == F.col("_item")).drop("_item")
    return poured.unionByName(chosen).drop("_load")


def chunk_ids(df: DataFrame, key: str, n: int, blocks: int | None = None) -> DataFrame:
    """Number ids in key order into groups of ``n``; ``n <= 0`` is one group."""
    if n <= 0:
        return df.withColumn("chunk", F.lit(0).cast("long"))
    at = B.running_position(df, [key], "_at", blocks=blocks)
    return at.withColumn("chunk", F.floor((F.col("_at") - 1) / n).cast("long")).drop("_at")


def revision_order(df: DataFrame, key: str, rev: str, blocks: int | None = None) -> DataFrame:
    """Revisions numbered from 1 within their item."""
    return B.running_position(df, [rev], "revision_number", keys=[key], blocks=blocks)
