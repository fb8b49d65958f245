"""Exact duplicates: one 128-bit hash per text, bytes compared inside hash groups.

Every step is a Spark aggregate or join. Groups of any size combine before the
shuffle, so a group that holds a third of all rows is one row per map task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, keyed_texts, written


def normalised(text: Column) -> Column:
    """Each run of white space as one space."""
    return F.regexp_replace(text, SPACE, " ")


def content_hash(text: Column) -> Column:
    """The 128-bit hash of a text."""
    return F.unhex(F.md5(text.cast("binary")))


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of: Callable[[Column], Column] = content_hash
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Rows are grouped by ``hash_of`` their normalised text. A second pass compares
    the texts themselves: a hash that stands for several texts is split by text,
    so a collision never joins different documents.

    Null text equals the empty text. The smallest id stays; a null id counts as
    the largest. Rows that repeat an id and a text are one group, of which exactly
    one row is kept. An empty table gives no rows.
    """
    base = keyed_texts(docs, id_col, text_col).select("doc_id", normalised(F.col("text")).alias("norm"))
    hashed = base.select("doc_id", hash_of(F.col("norm")).alias("hash"), "norm")
    # narrow and written once, so that the row number is the same for every reader
    rows = written(
        hashed.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "hash", F.sha2(F.col("norm").cast("binary"), 256).alias("sha")
        ),
        "hashed",
    )
    collided = (
        hashed.groupBy("hash", "norm").agg(F.lit(1).alias("one"))
        .groupBy("hash").agg(F.count(F.lit(1)).alias("texts"))
        .where("texts > 1").select("hash", F.lit(True).alias("several"))
    )
    # a table of its own, nearly always empty: the rows need not be dealt out by hash to meet it
    collided = written(collided, "collided")
    rows = rows.join(collided, "hash", "left").select(
        "row", "doc_id", "hash", "sha", F.when(F.col("several"), F.col("sha")).otherwise(F.lit("")).alias("part")
    )
    rows = written(rows, "grouped")
    groups = (
        rows.groupBy("hash", "part")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("size"))
        .where("size > 1")
        .select("hash", "part", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"), "size")
    )
    # as a table of its own, so that a join on a large group's key can be split
    groups = written(groups, "groups")
    alone = F.col("size").isNull()
    return rows.join(groups, ["hash", "part"], "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce(F.col("size"), F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("keep_row") == F.col("row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
