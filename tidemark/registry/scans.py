"""Queries over scans and change logs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import scan as S
from tidemark.registry.base import query, scratch



@query("scan_snapshot", "SELECT * FROM orders")
def scan_snapshot(t):
    return S.scan_snapshot(t.spark, f"{t.folder}/orders.parquet", t.orders.schema)


@query(
    "scan_incremental",
    "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-20'",
)
def scan_incremental(t):
    return S.scan_incremental(t.events, "ts", datetime(2024, 1, 10), datetime(2024, 1, 20))


@query(
    "scan_by_limit",
    "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-05' ORDER BY ts, event_id LIMIT 500",
)
def scan_by_limit(t):
    return S.scan_by_limit(t.events, "ts", "event_id", datetime(2024, 1, 5), 500)


@query(
    "scan_by_window",
    """
    SELECT event_id, ts, TIMESTAMP '2024-01-15' AS next_cursor FROM events
    WHERE ts > TIMESTAMP '2024-01-08' AND ts <= TIMESTAMP '2024-01-15'
    """,
)
def scan_by_window(t):
    rows, end = S.scan_by_window(t.events, "ts", datetime(2024, 1, 8), 7 * 86400, datetime(2024, 1, 29))
    return rows.select("event_id", "ts", end.alias("next_cursor"))


@query(
    "scan_compacted_windows",
    """
    WITH w AS (
      SELECT event_id, ts, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-03') - 1) // 86400000000 AS win
      FROM events WHERE ts > TIMESTAMP '2024-01-03' AND ts <= TIMESTAMP '2024-01-28 12:00:00'),
    c AS (SELECT win, count(*) AS n FROM w GROUP BY win),
    r AS (SELECT win, sum(n) OVER (ORDER BY win) - n AS before FROM c)
    SELECT event_id, ts,
           least(TIMESTAMP '2024-01-03' + to_days(CAST(w.win + 1 AS INTEGER)), TIMESTAMP '2024-01-28 12:00:00') AS window_until
    FROM w JOIN r USING (win) WHERE before < 2000
    """,
)
def scan_compacted_windows(t):
    return S.scan_compacted_windows(
        t.events.select("event_id", "ts"), "ts", datetime(2024, 1, 3), 86400, datetime(2024, 1, 28, 12), 2000
    )


_BOUNDS = """
  b AS (SELECT event_type, date_trunc('day', min(ts)) AS lo, max(ts) AS hi FROM events GROUP BY event_type),
  g AS (SELECT event_type, lo, hi, unnest(range(0, 400)) AS window_id FROM b),
  p AS (SELECT event_type, CAST(window_id AS INTEGER) AS window_id,
               lo + to_days(CAST(3 * window_id AS INTEGER)) AS since,
               least(lo + to_days(CAST(3 * (window_id + 1) AS INTEGER)), hi) AS until
        FROM g WHERE lo + to_days(CAST(3 * window_id AS INTEGER)) < hi)
"""


def event_bounds(t):
    return t.events.groupBy("event_type").agg(
        F.date_trunc("day", F.min("ts").cast("timestamp")).alias("lo"), F.max("ts").alias("hi")
    )


@query("plan_windows", f"WITH {_BOUNDS} SELECT * FROM p")
def plan_windows(t):
    return S.plan_windows(event_bounds(t), "lo", "hi", 3)


@query(
    "scan_partitioned",
    """
    WITH b AS (SELECT date_trunc('day', min(ts)) AS lo, max(ts) AS hi FROM events),
    g AS (SELECT lo, hi, unnest(range(0, 400)) AS window_id FROM b),
    p AS (SELECT CAST(window_id AS INTEGER) AS window_id, lo + to_days(CAST(3 * window_id AS INTEGER)) AS since,
                 least(lo + to_days(CAST(3 * (window_id + 1) AS INTEGER)), hi) AS until
          FROM g WHERE lo + to_days(CAST(3 * window_id AS INTEGER)) < hi)
    SELECT e.event_id, e.ts, p.window_id FROM events e JOIN p ON e.ts > p.since AND e.ts <= p.until
    """,
)
def scan_partitioned(t):
    bounds = t.events.agg(F.date_trunc("day", F.min("ts").cast("timestamp")).alias("lo"), F.max("ts").alias("hi"))
    windows = S.plan_windows(bounds, "lo", "hi", 3)
    return S.scan_partitioned(t.events.select("event_id", "ts"), "ts", windows)


@query(
    "scan_deletes",
    """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderstatus = 'F' AND o_orderdate > TIMESTAMP '1998-01-01'
    """,
)
def scan_deletes(t):
    gone = t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderdate")
    return S.scan_deletes(gone, "o_orderdate", datetime(1998, 1, 1))


@query(
    "scan_archived_as_deletes",
    """
    WITH a AS (SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate + INTERVAL 1 DAY END AS archived_at,
                      o_orderdate FROM orders WHERE o_orderstatus = 'F')
    SELECT o_orderkey, coalesce(archived_at, o_orderdate) AS o_orderdate FROM a
    WHERE coalesce(archived_at, o_orderdate) > TIMESTAMP '1999-01-01'
    """,
)
def scan_archived_as_deletes(t):
    rows = t.orders.select(
        "o_orderkey",
        "o_orderdate",
        (F.col("o_orderstatus") == "F").alias("archived"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("archivedAt"),
    )
    out = S.scan_archived_as_deletes(rows, "o_orderdate", since=datetime(1999, 1, 1))
    return out.select("o_orderkey", "o_orderdate")


def history(t):
    """A change log out of lineitem: one record per line, added or deleted messages."""
    msg = F.struct(
        F.concat(F.lit("m"), F.col("l_partkey")).alias("id"),
        F.concat(F.lit("t"), F.floor(F.col("l_partkey") / 10)).alias("threadId"),
    )
    blank = F.struct(F.lit(None).cast("string").alias("id"), F.lit("t0").alias("threadId"))
    entries = F.array(F.struct(msg.alias("message")), F.struct(blank.alias("message")))
    none = F.array().cast("array<struct<message:struct<id:string,threadId:string>>>")
    gone = F.col("l_returnflag") == "R"
    return t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("id"),
        F.when(gone, none).otherwise(entries).alias("messagesAdded"),
        F.when(gone, entries).otherwise(none).alias("messagesDeleted"),
    )


@query(
    "history_deletes",
    """
    SELECT 'm' || l_partkey AS id, 't' || (l_partkey // 10) AS thread_id, min(l_orderkey) AS history_id
    FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_partkey
    """,
)
def history_deletes(t):
    return S.history_deletes(history(t))


@query(
    "history_deletes_thread",
    """
    SELECT 't' || (l_partkey // 10) AS id, min(l_orderkey) AS history_id
    FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_partkey // 10
    """,
)
def history_deletes_thread(t):
    return S.history_deletes(history(t), "thread")


@query(
    "history_added",
    "SELECT DISTINCT 'm' || l_partkey AS id FROM lineitem WHERE l_returnflag <> 'R' AND l_orderkey > 999",
)
def history_added(t):
    return S.history_added(history(t), 999)


@query(
    "delta_feed",
    """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS o_totalprice,
           CASE WHEN o_orderstatus <> 'F' THEN o_orderdate END AS o_orderdate, o_orderstatus = 'F' AS _deleted
    FROM orders
    """,
)
def delta_feed(t):
    feed = t.orders.select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
        F.when(F.col("o_orderstatus") == "F", F.lit(True)).alias("removed"),
    )
    return S.delta_feed(feed, "removed", "o_orderkey", ["o_custkey"])


@query(
    "read_jsonl",
    """
    SELECT event_type = 'error' AS bad, count(*) AS n, round(sum(CASE WHEN event_type <> 'error' THEN value END), 2) AS total
    FROM events GROUP BY 1
    """,
)
def read_jsonl(t):
    """Event files of JSON lines; error events come as broken lines."""
    whole = F.to_json(F.struct("event_id", "event_type", "value"))
    line = F.when(F.col("event_type") == "error", F.concat(F.lit('{"event_id": '), F.col("event_id"))).otherwise(whole)
    place = f"{scratch(t.spark)}/lines"
    t.events.select(line.alias("value")).repartition(4).write.text(place)
    good, bad = S.read_jsonl(t.spark, place, "event_id long, event_type string, value double")
    total = good.agg(F.lit(False).alias("bad"), F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return total.unionByName(bad.select(F.lit(True).alias("bad"), F.col("bad_lines").alias("n"), F.lit(None).cast("double").alias("total")))


@query(
    "csv_report",
    """
    SELECT c_name AS customer_name, nullif(CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END, '') AS market_segment,
           CAST(c_custkey AS VARCHAR) AS device_id FROM customer
    """,
)
def csv_report(t):
    raw = t.customer.select(
        F.col("c_name").alias("﻿Customer Name"),
        F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_mktsegment")).alias("Market Segment"),
        F.col("c_custkey").cast("string").alias("Device ID"),
    )
    place = f"{scratch(t.spark)}/report"
    raw.repartition(3).write.option("header", True).csv(place)
    return S.read_csv_report(t.spark, place)


@query("unwrap_records", "SELECT o_orderkey AS id, o_orderstatus AS status FROM orders")
def unwrap_records(t):
    """Orders in four envelope forms: known key, bare array, unknown key, empty neighbours."""
    row = F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status")))
    form = F.col("o_orderstatus")
    raw = (
        F.when(form == "F", F.concat(F.lit('{"items":['), row, F.lit('],"offset":0}')))
        .when(form == "O", F.concat(F.lit("["), row, F.lit("]")))
        .otherwise(F.concat(F.lit('{"notes":[],"tags":["x","y"],"rows":['), row, F.lit("]}")))
    )
    out = S.unwrap_records(t.orders.select(raw.alias("raw")))
    return out.select(
        F.try_variant_get("record", "$.id", "bigint").alias("id"),
        F.try_variant_get("record", "$.status", "string").alias("status"),
    )


@query("unwrap_records_key", "SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 5 <> 4")
def unwrap_records_key(t):
    """A named key beside bare arrays, other known keys and unknown ones."""
    row = F.concat(F.lit('[{"id":'), "o_orderkey", F.lit("}]"))
    form = F.col("o_orderkey") % 5
    raw = (
        F.when(form == 0, F.concat(F.lit('{"userRates":'), row, F.lit("}")))
        .when(form == 1, row)
        .when(form == 2, F.concat(F.lit('{"data":'), row, F.lit("}")))
        .when(form == 3, F.concat(F.lit('{"items":[],"userRates":'), row, F.lit("}")))
        .otherwise(F.concat(F.lit('{"other":'), row, F.lit("}")))
    )
    out = S.unwrap_records(t.orders.select(raw.alias("raw")), key="userRates")
    return out.select(F.try_variant_get("record", "$.id", "bigint").alias("id"))


@query(
    "sheet_to_table",
    """
    SELECT CAST(c_custkey + 1 AS INTEGER) AS row_index, c_name AS "Customer_Name", c_mktsegment AS _col1,
           CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey AS VARCHAR) ELSE '' END AS "Nation_Key"
    FROM customer
    """,
)
def sheet_to_table(t):
    """Customers as sheet cells under a header row; some rows are short."""
    cells = F.array("c_name", "c_mktsegment")
    body = t.customer.select(
        (F.col("c_custkey") + 1).cast("int").alias("row_index"),
        F.when(F.col("c_acctbal") >= 0, F.concat(cells, F.array(F.col("c_nationkey").cast("string"))))
        .otherwise(cells)
        .alias("values"),
    )
    head = t.spark.createDataFrame([(0, ["Customer Name", " ", "Nation Key!"])], body.schema)
    return S.sheet_to_table(head.unionByName(body))


@query(
    "list_documents",
    "SELECT d.doc_id, d.source, d.n_chars, d.text FROM documents d WHERE d.lang = 'en' ORDER BY d.doc_id DESC",
)
def list_documents(t):
    listing = t.documents.select("doc_id", "lang", "source", "n_chars")
    content = t.documents.select("doc_id", "text")
    return S.list_documents(listing, "lang", "en", "doc_id", content, "doc_id").drop("lang")


