"""Rows along a Z-order curve, and an index of the files they end up in.

Every cluster column is ranked by cut points from a bounded sample of rows, and the bits
of the ranks are interleaved. Rows near each other on the curve are near in every
column, so a file has narrow bounds in all of them and a filter on any skips most files.
The sample shapes the layout only; which rows a read returns never depends on it.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a column's rank.
BITS = 6
#: Rows that are looked at to find the cut points; they reach the driver.
SAMPLE = 8192

Range = tuple[str, Any, Any]  # column, least and greatest value (None: open), both inclusive


def cut_points(rows: DataFrame, columns: Sequence[str], count: int) -> dict[str, list]:
    """Up to ``2 ** BITS - 1`` cut points of each column, at equal shares of about ``SAMPLE`` rows."""
    draw = F.pmod(F.xxhash64(*columns, F.monotonically_increasing_id()), F.lit(1_000_003)) / 1_000_003.0
    few = rows.select(*columns)
    if count > SAMPLE:
        few = few.where(draw < F.lit(SAMPLE / count))
    few = few.limit(2 * SAMPLE).collect()
    out = {}
    for c in columns:
        values = sorted(r[c] for r in few if r[c] is not None and r[c] == r[c])
        steps = 1 << BITS
        picked = [values[len(values) * k // steps] for k in range(1, steps)] if values else []
        out[c] = [v for i, v in enumerate(picked) if i == 0 or v != picked[i - 1]]
    return out


def rank(column: Column, cuts: Sequence, kind: T.DataType) -> Column:
    """How many cut points a value reaches, by halving; nulls rank lowest."""
    if not cuts:
        return F.lit(0)
    middle = len(cuts) // 2
    above = F.lit(middle + 1) + rank(column, cuts[middle + 1 :], kind)
    return F.when(column >= F.lit(cuts[middle]).cast(kind), above).otherwise(rank(column, cuts[:middle], kind))


def place_on_curve(rows: DataFrame, cuts: dict[str, list]) -> Column:
    """Position on the Z-order curve: the columns' rank bits in turn."""
    ranks = {c: rank(F.col(c), points, rows.schema[c].dataType) for c, points in cuts.items() if points}
    spread = F.lit(0).cast("long")
    for i, ranked in enumerate(ranks.values()):
        number = ranked.cast("long")
        for bit in range(BITS):
            spread = spread.bitwiseOR(F.shiftleft(F.shiftright(number, bit).bitwiseAND(F.lit(1).cast("long")), bit * len(ranks) + i))
    return spread


def file_index(files: DataFrame, columns: Sequence[str], node: str) -> DataFrame:
    """One row per file: path, node, rows and the bounds ``lo_<column>``, ``hi_<column>``; a null bound is none."""
    bounds = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]
    grouped = files.select("_metadata.file_path", node, *columns).groupBy("file_path", node)
    return grouped.agg(F.count("*").alias("rows"), *bounds)


def may_hold(ranges: Sequence[Range], columns: dict[str, T.DataType]) -> Column:
    """Filter on an index: files whose bounds meet every range. Columns the index lacks skip nothing."""
    keep = F.lit(True)
    for name, low, high in ranges:
        if name not in columns:
            continue
        least, most = F.col(f"lo_{name}"), F.col(f"hi_{name}")
        # a file whose values are all null cannot match a range with a bound
        if low is not None:
            keep = keep & F.coalesce(most >= F.lit(low).cast(columns[name]), F.lit(False))
        if high is not None:
            keep = keep & F.coalesce(least <= F.lit(high).cast(columns[name]), F.lit(False))
    return keep


def in_ranges(ranges: Sequence[Range], schema: T.StructType) -> Column:
    """The ranges as a row filter that reaches the scan."""
    keep = F.lit(True)
    for name, low, high in ranges:
        kind = schema[name].dataType
        if low is not None:
            keep = keep & (F.col(name) >= F.lit(low).cast(kind))
        if high is not None:
            keep = keep & (F.col(name) <= F.lit(high).cast(kind))
    return keep
