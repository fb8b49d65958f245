"""Sorting, limits and pages.

Deep pages never sort into one task: the position of a row comes from range
blocks (see ``plans.blocks``), the first page from TakeOrderedAndProject.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans import blocks as B


def _field(path: str | Column) -> Column:
    return F.col(path) if isinstance(path, str) else path


def sort_path(df: DataFrame, path: str, tie: str, order: str = "asc") -> DataFrame:
    """Sort by a (dotted) path; missing values last going up, first going down."""
    c = _field(path)
    return df.orderBy(c.desc_nulls_first() if order == "desc" else c.asc_nulls_last(), F.col(tie))


def page(df: DataFrame, order: list[str], number: int, size: int, blocks: int | None = None) -> DataFrame:
    """Page ``number`` (from 1) of ``size`` rows in a total order, with ``next_page`` or null."""
    if number < 1 or size < 1:
        raise ValueError("page and size start at 1")
    at = B.running_position(df, order, "_at", blocks=blocks)
    low, high = (number - 1) * size, number * size
    window = at.where((F.col("_at") > low) & (F.col("_at") <= high + 1))
    follows = window.select(F.when(F.max("_at") > high, F.lit(number + 1)).alias("next_page"))
    return window.where(F.col("_at") <= high).drop("_at").withColumn("next_page", follows.scalar())


# rows up to which one task may hold the head of a sort
SHALLOW_ROWS = 100000


def offset_limit(df: DataFrame, order: list[str], offset: int, limit: int) -> DataFrame:
    """Rows ``offset .. offset + limit`` in order; a limit of 0 or less is empty.

    A shallow slice is a top-k; a deep one goes by row positions, since a top-k
    of that size would end up in one task.
    """
    if limit <= 0:
        return df.where(F.lit(False))
    offset = max(offset, 0)
    if offset + limit <= SHALLOW_ROWS:
        return df.orderBy(*order).offset(offset).limit(limit)
    at = B.running_position(df, order, "_at")
    return at.where((F.col("_at") > offset) & (F.col("_at") <= offset + limit)).drop("_at")


def keyset_page(
    df: DataFrame, cursor: str, tie: str, last: Any, last_tie: Any, n: int
) -> DataFrame:
    """The next ``n`` rows after ``(last, last_tie)``; rows that share a cursor are never lost.

    A row without a cursor is not readable by cursor and stays out (``uncursored``
    counts them); a row with a cursor but no tie-break fails the read.
    """
    if not tie:
        raise ValueError("a unique tie-break column is required")
    c, t = F.col(cursor), F.col(tie)
    if last is not None:
        mark = F.lit(last).cast(df.schema[cursor].dataType)
        if last_tie is None:
            df = df.where(c > mark)
        else:
            # the first clause alone is pushed to the scan
            df = df.where((c >= mark) & ((c > mark) | t.isNull() | (t > F.lit(last_tie))))
    kind = df.schema[tie].dataType
    checked = df.where(c.isNotNull()).withColumn(
        tie, F.when(t.isNotNull(), t).otherwise(F.raise_error(F.lit(f"a row has no value in the tie-break column {tie}")).cast(kind))
    )
    return checked.orderBy(c, t).limit(n)


def uncursored(df: DataFrame, cursor: str) -> DataFrame:
    """Number of rows that reading by cursor leaves out."""
    return df.agg(F.count_if(F.col(cursor).isNull()).alias("uncursored"))


def recent(df: DataFrame, newest: str, tie: str, n: int = 10, text: str | None = None, width: int = 100) -> DataFrame:
    """The ``n`` newest rows, with a short preview of a text column."""
    if text:
        df = df.withColumn(text, F.substring(F.col(text), 1, width))
    return df.orderBy(F.col(newest).desc_nulls_last(), F.col(tie)).limit(n)


def cap_records(
    df: DataFrame, cursor: str, tie: str, n: int, last: Any = None, last_tie: Any = None
) -> tuple[DataFrame, DataFrame]:
    """At most ``n`` rows and the position to resume from: ``(resume_cursor, resume_tie)``."""
    taken = keyset_page(df, cursor, tie, last, last_tie, n)
    mark = taken.agg(F.max(F.struct(cursor, tie)).alias("m")).select(
        F.col(f"m.{cursor}").alias("resume_cursor"), F.col(f"m.{tie}").alias("resume_tie")
    )
    return taken, mark
