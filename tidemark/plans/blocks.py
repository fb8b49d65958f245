"""Ordered work on keys of any size.

A window ``partitionBy(key).orderBy(seq)`` puts a whole key into one task, so
one key holding a third of the rows stops the job.  The rows per key are
counted first (only the key columns are read, with map-side combine).  Without
a hot key a plain window runs.  Hot keys are cut along quantiles of their
order column and their windows run per ``(key, block)``; the rows next to a
block border are carried over as extra *edge* rows, found by an aggregation
over the hot rows alone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = "_block"
EDGE = "_edge"
_MAX_CUTS = 4095
# rows of one key that a single task sorts without trouble
HOT_ROWS = 1000000


def comparable(df: DataFrame, name: str) -> Column:
    """The order column as a number (micros for times) or as text, to compare with cuts."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if isinstance(kind, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return F.col(name).cast("long")
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.col(name).cast("double")
    if isinstance(kind, T.StringType):
        return F.col(name)
    raise TypeError(f"cannot order blocks by {name}: {kind.simpleString()}")


def default_blocks(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def order_cuts(df: DataFrame, order: str, blocks: int | None = None) -> list:
    """Quantile cut points of ``order``, at most 4095.

    Numbers and times by an approximate quantile, text by a random sample of a
    fixed size.  Cuts only balance the work; any choice of them is correct.
    """
    blocks = blocks or default_blocks(df.sparkSession)
    size = 1
    while size < min(blocks, _MAX_CUTS + 1):
        size *= 2
    if size == 1:
        return []
    if isinstance(df.schema[order].dataType, T.StringType):
        sample = df.select(order).where(F.col(order).isNotNull()).orderBy(F.rand(7)).limit(32 * size)
        drawn = sorted(r[order] for r in sample.collect())
        return [drawn[i * len(drawn) // size] for i in range(1, size)] if drawn else []
    shares = [i / size for i in range(1, size)]
    row = df.agg(
        F.percentile_approx(comparable(df, order), shares, max(10000, 4 * size)).alias("cuts")
    ).first()
    return list(row["cuts"] or [])


def block_of(value: Column, cuts: Sequence) -> Column:
    """Number of cuts at or below ``value``, by binary search in a literal array."""
    if not cuts:
        return F.lit(0)
    half = (len(cuts) + 1) // 2
    steps = []
    while half:
        steps.append(half)
        half //= 2
    bounds = F.array(*[F.lit(c) for c in cuts])
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, s: F.when(value >= F.get(bounds, at + s - 1), at + s).otherwise(at),
    )


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> list[int]:
    """Hashes of the keys with more than ``hot_rows`` rows, the largest 4096 at most.

    Only these few numbers come to the driver.  A key beyond that rank holds
    less than a 4096th of the table.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    counts = df.groupBy(key_hash(keys).alias("k")).agg(F.count("*").alias("n")).where(F.col("n") > hot_rows)
    return [r["k"] for r in counts.orderBy(F.desc("n")).limit(_MAX_CUTS + 1).collect()]


class Split:
    """Which keys are hot and where their order column is cut."""

    def __init__(self, keys: Sequence[str], order: str, hot: Sequence[int], cuts: Sequence) -> None:
        self.keys, self.order, self.hot, self.cuts = list(keys), order, list(hot), list(cuts)

    @property
    def plain(self) -> bool:
        return not self.hot or not self.cuts

    def is_hot(self) -> Column:
        return key_hash(self.keys).isin(self.hot)

    def add(self, df: DataFrame) -> DataFrame:
        """The block number; 0 for every key that is not hot."""
        if self.plain:
            return df.withColumn(BLOCK, F.lit(0))
        spot = F.coalesce(block_of(comparable(df, self.order), self.cuts), F.lit(0))
        return df.withColumn(BLOCK, F.when(self.is_hot(), spot).otherwise(F.lit(0)))


def find_split(
    df: DataFrame, keys: Sequence[str], order: str, blocks: int | None = None, hot_rows: int | None = None
) -> Split:
    """Measure ``df`` and decide how its keys are split."""
    hot = hot_keys(df, keys, hot_rows)
    if not hot:
        return Split(keys, order, [], [])
    return Split(keys, order, hot, order_cuts(df.where(key_hash(keys).isin(hot)), order, blocks))


def with_edges(
    df: DataFrame, order: Sequence[str], split: Split, before: bool = True, after: bool = True
) -> DataFrame:
    """Rows plus, per hot ``(key, block)``, the last row before and the first row after it."""
    keys = split.keys
    out = split.add(df).withColumn(EDGE, F.lit(False))
    if split.plain:
        return out
    whole, rank = F.struct(*df.columns), F.struct(*order)
    ends = split.add(df.where(split.is_hot())).groupBy(*keys, BLOCK).agg(
        F.max_by(whole, rank).alias("last_row"), F.min_by(whole, rank).alias("first_row")
    )
    over = Window.partitionBy(*keys).orderBy(BLOCK)
    carried = []
    if before:
        carried.append(F.lag("last_row").over(over))
    if after:
        carried.append(F.lead("first_row").over(over))
    edges = (
        ends.select(BLOCK, F.array(*carried).alias("rows"))
        .select(BLOCK, F.explode("rows").alias("row"))
        .where(F.col("row").isNotNull())
        .select("row.*", BLOCK, F.lit(True).alias(EDGE))
    )
    return out.unionByName(edges)


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    build: Callable[[WindowSpec], dict[str, Column]],
    before: bool = True,
    after: bool = True,
    split: Split | None = None,
) -> DataFrame:
    """Add columns that look one row back or ahead within a key.

    ``build`` gets the window and returns ``{name: column}``; only offsets of
    one row are valid.  ``order`` must be unique within a key.
    """
    split = split or find_split(df, keys, order[0])
    if split.plain:
        return df.withColumns(build(Window.partitionBy(*keys).orderBy(*order)))
    over = Window.partitionBy(*keys, BLOCK).orderBy(*order)
    edged = with_edges(df, order, split, before, after)
    return edged.withColumns(build(over)).where(~F.col(EDGE)).drop(BLOCK, EDGE)


def running_position(
    df: DataFrame,
    order: Sequence[str],
    name: str,
    weight: Column | None = None,
    keys: Sequence[str] = (),
    blocks: int | None = None,
    split: Split | None = None,
) -> DataFrame:
    """Running total of ``weight`` (default: row number from 1) in a total order.

    Without keys, and for hot keys, the rows are cut into blocks.  The totals
    per block form a table of at most one row per ``(key, block)``; only that
    table is summed serially, the rows themselves stay spread out.
    """
    weighted = df.withColumn("_weight", F.lit(1) if weight is None else weight)
    upto = Window.unboundedPreceding, Window.currentRow
    if keys:
        split = split or find_split(df, keys, order[0], blocks)
        if split.plain:
            over = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*upto)
            return weighted.withColumn(name, F.sum("_weight").over(over)).drop("_weight")
        blocked = split.add(weighted)
    else:
        spot = block_of(comparable(df, order[0]), order_cuts(df, order[0], blocks))
        blocked = weighted.withColumn(BLOCK, F.coalesce(spot, F.lit(0)))
    inside = Window.partitionBy(*keys, BLOCK).orderBy(*order).rowsBetween(*upto)
    totals = blocked.groupBy(*keys, BLOCK).agg(F.sum("_weight").alias("_total"))
    ahead = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(
        F.col(BLOCK).alias("_base_block"),
        *[F.col(k).alias(f"_base_{k}") for k in keys],
        F.coalesce(F.sum("_total").over(ahead), F.lit(0)).alias("_base"),
    )
    match = F.col(BLOCK) == F.col("_base_block")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_base_{k}"))
    summed = blocked.withColumn("_inside", F.sum("_weight").over(inside)).join(base, match)
    return summed.withColumn(name, F.col("_base") + F.col("_inside")).drop(
        BLOCK, "_weight", "_inside", "_base", "_base_block", *[f"_base_{k}" for k in keys]
    )
