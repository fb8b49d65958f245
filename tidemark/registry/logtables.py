"""Queries over log-structured targets: orders that arrive in batches, with updates and deletes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans import apply as A
from tidemark.plans.logtable import CHANGE, VERSION, LogTarget, replayed
from tidemark.registry.base import query, scratch

BATCHES = 12


def batch(t, number: int) -> DataFrame:
    """A twelfth of the orders; a third of the twelfth before with a new price; tombstones for a fifth of the one before that."""
    slot, seq = F.col("o_orderkey") % BATCHES, F.lit(number)

    def part(where: Column, price: Column, gone: bool) -> DataFrame:
        return t.orders.where(where).select(
            F.col("o_orderkey").alias("id"), seq.alias("seq"), "o_custkey", "o_orderdate", price.alias("price"), F.lit(gone).alias(A.DELETED)
        )

    price = F.col("o_totalprice")
    third, fifth = F.col("o_orderkey") % 3 == 0, F.col("o_orderkey") % 5 == 0
    return (
        part(slot == number, price, False)
        .unionByName(part((slot == number - 1) & third, price + 1, False))
        .unionByName(part((slot == number - 2) & fifth, price, True))
    )


def filled(t, batches: int = BATCHES, **options) -> LogTarget:
    """A target after so many batches."""
    compact = options.pop("compact", True)
    target = LogTarget(t.spark, f"{scratch(t.spark)}/target", ["id"], ["seq"], **options)
    for number in range(batches):
        target.apply(batch(t, number), batch_id=number, compact=compact)
    return target


def expected(batches: int) -> str:
    """Rows that are left after so many batches."""
    return f"""
        SELECT o_orderkey AS id, o_custkey,
               o_totalprice + CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % {BATCHES} < {batches - 1} THEN 1 ELSE 0 END AS price
        FROM orders WHERE o_orderkey % {BATCHES} < {batches} AND NOT (o_orderkey % 5 = 0 AND o_orderkey % {BATCHES} < {batches - 2})"""


@query("target_many_small_batches", expected(BATCHES))
def target_many_small_batches(t):
    """Batches appended as runs; a reader merges them, some compacted on the way."""
    return filled(t, fanout=5).read().select("id", "o_custkey", "price")


@query("target_compacted", expected(BATCHES))
def target_compacted(t):
    """All runs merged into leaves that split as they outgrow their size; late older rows change nothing."""
    target = filled(t, fanout=5, split_bytes=16 << 10)
    late = batch(t, BATCHES - 1).withColumns({"seq": F.lit(-1), "price": F.lit(0.0)})
    target.apply(late, "late")
    target.compact(full=True)
    return target.read().select("id", "o_custkey", "price")


@query("target_travel", expected(5))
def target_travel(t):
    """An older version, read after later batches and compactions."""
    return filled(t, fanout=20, keep=20).read(version=5).select("id", "o_custkey", "price")


@query(
    "target_history_log",
    f"""
    WITH c AS (
        SELECT o_orderkey AS id, o_orderkey % {BATCHES} AS seq, o_totalprice AS price, false AS gone FROM orders
        UNION ALL SELECT o_orderkey, o_orderkey % {BATCHES} + 1, o_totalprice + 1, false FROM orders
                  WHERE o_orderkey % 3 = 0 AND o_orderkey % {BATCHES} < {BATCHES - 1}
        UNION ALL SELECT o_orderkey, o_orderkey % {BATCHES} + 2, o_totalprice, true FROM orders
                  WHERE o_orderkey % 5 = 0 AND o_orderkey % {BATCHES} < {BATCHES - 2}
    ),
    h AS (SELECT *, lead(seq) OVER (PARTITION BY id ORDER BY seq) AS until FROM c)
    SELECT id, price, CAST(seq AS INTEGER) AS valid_from, CAST(until AS INTEGER) AS valid_to FROM h WHERE NOT gone
    """,
)
def target_history_log(t):
    """History of every order, half of it in compacted leaves."""
    return filled(t, scd=2, fanout=5, split_bytes=32 << 10).read().select("id", "price", "valid_from", "valid_to")


FEED = 6


@query(
    "target_feed",
    f"""
    SELECT o_orderkey AS id, 'insert' AS change, CAST(o_orderkey % {BATCHES} + 1 AS INTEGER) AS version, NULL::DOUBLE AS price_before, o_totalprice AS price_after
    FROM orders WHERE o_orderkey % {BATCHES} < {FEED}
    UNION ALL
    SELECT o_orderkey, 'update', CAST(o_orderkey % {BATCHES} + 2 AS INTEGER), o_totalprice, o_totalprice + 1
    FROM orders WHERE o_orderkey % {BATCHES} < {FEED - 1} AND o_orderkey % 3 = 0
    UNION ALL
    SELECT o_orderkey, 'delete', CAST(o_orderkey % {BATCHES} + 3 AS INTEGER),
           o_totalprice + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END, NULL
    FROM orders WHERE o_orderkey % {BATCHES} < {FEED - 2} AND o_orderkey % 5 = 0
    """,
)
def target_feed(t):
    """What each batch inserted, updated and deleted, with the price before and after."""
    rows = filled(t, FEED, feed=True, compact=False).changes(0)
    return rows.select(
        "key.id", F.col(CHANGE).alias("change"), F.col(VERSION).alias("version"), F.col("before.price").alias("price_before"),
        F.col("after.price").alias("price_after"),
    )


@query("target_replayed", expected(FEED))
def target_replayed(t):
    """The table rebuilt from its change feed alone."""
    return replayed(filled(t, FEED, feed=True, fanout=3).changes(0)).select("id", "o_custkey", "price")


@query(
    "target_evolved",
    """
    SELECT p_partkey AS id,
           CASE p_partkey % 3 WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN CAST(p_size * 10000000000 AS VARCHAR) ELSE 'S' || p_size END AS label,
           CASE WHEN p_partkey % 3 = 2 THEN p_name END AS name
    FROM part
    """,
)
def target_evolved(t):
    """A column that turns from int to long to text and gets a new name, and one that is added; old runs are read as they are."""
    target = LogTarget(t.spark, f"{scratch(t.spark)}/target", ["id"], ["seq"])
    size = F.col("p_size").cast("int")
    for number, column in enumerate((size, size.cast("long") * 10_000_000_000, F.concat(F.lit("S"), size.cast("string")))):
        rows = t.part.where(F.col("p_partkey") % 3 == number).select(
            F.col("p_partkey").alias("id"), F.lit(1).alias("seq"), column.alias("size"), *(["p_name"] if number == 2 else [])
        )
        target.apply(rows)
    target.rename("size", "label")
    target.rename("p_name", "name")
    return target.read().select("id", "label", "name")


@query(
    "target_pruned",
    """
    SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, true AS few_files FROM orders
    WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate <= TIMESTAMP '1995-06-30'
      AND o_custkey <= (SELECT CAST(floor(max(c_custkey) / 10) AS BIGINT) FROM customer)
    """,
)
def target_pruned(t):
    """A range over two columns, read from files along a curve: under a tenth of them is opened."""
    top = int(t.customer.agg(F.max("c_custkey")).first()[0] / 10)
    orders = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"), "o_totalprice", F.lit(1).alias("seq"))
    target = LogTarget(
        t.spark, f"{scratch(t.spark)}/target", ["o_orderkey"], ["seq"], cluster_by=["o_orderdate", "o_custkey"],
        file_rows=max(1, orders.count() // 144), split_bytes=1 << 40,
    )
    target.apply(orders)
    target.compact(full=True)
    ranges = (("o_orderdate", "1995-01-01", "1995-06-30"), ("o_custkey", None, top))
    opened, there = target.files(*ranges)
    return target.read(*ranges).select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", F.lit(opened * 10 < there).alias("few_files"))
