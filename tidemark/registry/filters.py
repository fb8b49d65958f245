"""Queries over filters, paging and set operations."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import filters as Fl
from tidemark.operators import paging as P
from tidemark.operators import setops as U
from tidemark.registry.base import query


@query(
    "apply_filters",
    """
    SELECT * FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_totalprice >= 100000.0 AND o_totalprice < 400000.0
      AND (o_orderpriority IS NULL OR o_orderpriority <> '5-LOW')
    """,
)
def apply_filters(t):
    specs = [
        ("status", "o_orderstatus", "in"),
        ("min_price", "o_totalprice", "gte"),
        ("max_price", "o_totalprice", "lt"),
        ("not_priority", "o_orderpriority", "ne"),
        ("key", "o_orderkey", "eq"),
    ]
    params = {"status": "F, P", "min_price": "100000", "max_price": "400000", "not_priority": "5-LOW"}
    return Fl.apply_filters(t.orders, specs, params)


@query("filter_exact", "SELECT * FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'")
def filter_exact(t):
    return Fl.filter_exact(
        t.orders, ["o_orderstatus", "o_orderpriority", "o_custkey"], o_orderstatus="O", o_orderpriority="1-URGENT"
    )


@query("filter_search", "SELECT * FROM part WHERE regexp_matches(p_name, '^(red|blue) .*g')")
def filter_search(t):
    return Fl.filter_search(t.part, "p_name", "^(red|blue) .*g")


@query("filter_name_wildcard", "SELECT * FROM part WHERE p_name ILIKE '%e_ w%t'")
def filter_name_wildcard(t):
    return Fl.filter_name_wildcard(t.part, "p_name", "*E? W*t")


@query(
    "report_filter",
    """
    SELECT event_id, event_type, value FROM events
    WHERE (lower(event_type) = 'click' OR contains(lower(event_type), 'err')) AND NOT (value > 50.0)
    """,
)
def report_filter(t):
    spec = {
        "andGroup": {
            "expressions": [
                {
                    "orGroup": {
                        "expressions": [
                            {"filter": {"fieldName": "event_type", "stringFilter": {"value": "click"}}},
                            {"filter": {"fieldName": "event_type", "stringFilter": {"matchType": "CONTAINS", "value": "ERR"}}},
                        ]
                    }
                },
                {
                    "notExpression": {
                        "filter": {
                            "fieldName": "value",
                            "numericFilter": {"operation": "GREATER_THAN", "value": {"int64Value": "50"}},
                        }
                    }
                },
            ]
        }
    }
    return Fl.report_filter(t.events.select("event_id", "event_type", "value"), json.dumps(spec))


@query("strictly_after", "SELECT event_id, ts FROM events WHERE ts > (TIMESTAMP '2024-01-15 12:00:00')")
def strictly_after(t):
    return Fl.strictly_after(t.events.select("event_id", "ts"), "ts", datetime(2024, 1, 15, 12))


@query("half_open", "SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-02' AND ts <= TIMESTAMP '2024-01-09'")
def half_open(t):
    return Fl.half_open(t.events.select("event_id", "ts"), "ts", datetime(2024, 1, 2), datetime(2024, 1, 9))


@query("half_open_first", "SELECT event_id, ts FROM events WHERE ts <= TIMESTAMP '2024-01-09'")
def half_open_first(t):
    return Fl.half_open(t.events.select("event_id", "ts"), "ts", None, datetime(2024, 1, 9))


@query(
    "inclusive_days",
    """
    SELECT *, true AS last_window FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-06-01' AND DATE '1998-06-30'
    UNION ALL
    SELECT *, false FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-05-01' AND DATE '1998-05-31'
    """,
)
def inclusive_days(t):
    last = Fl.inclusive_days(t.orders, "o_orderdate", "1998-06-01", "1998-06-30")
    inner = Fl.inclusive_days(t.orders, "o_orderdate", "1998-05-01", "1998-06-01", last=False)
    return last.withColumn("last_window", F.lit(True)).unionByName(inner.withColumn("last_window", F.lit(False)))


_HOLES = "CASE WHEN event_type = 'error' THEN NULL ELSE ts END"


def holed(t):
    """Events whose error rows lost their time."""
    return t.events.select("event_id", F.when(F.col("event_type") != "error", F.col("ts")).alias("ts"))


@query("drop_null_keys", f"SELECT * FROM (SELECT event_id, {_HOLES} AS ts FROM events) WHERE ts IS NOT NULL")
def drop_null_keys(t):
    return Fl.drop_null_keys(holed(t), ["event_id", "ts"])


@query(
    "null_cursor_policy",
    f"""
    WITH h AS (SELECT event_id, {_HOLES} AS ts FROM events)
    SELECT event_id, ts, 'keep' AS policy FROM h WHERE ts > TIMESTAMP '2024-01-20' OR ts IS NULL
    UNION ALL SELECT event_id, ts, 'drop' FROM h WHERE ts > TIMESTAMP '2024-01-20'
    """,
)
def null_cursor_policy(t):
    since = datetime(2024, 1, 20)
    keep = Fl.null_cursor_policy(holed(t), "ts", since, "keep").withColumn("policy", F.lit("keep"))
    return keep.unionByName(Fl.null_cursor_policy(holed(t), "ts", since, "drop").withColumn("policy", F.lit("drop")))


@query(
    "overlapping",
    """
    WITH f AS (SELECT l_orderkey, l_linenumber, l_shipdate AS start_time,
                      CASE WHEN l_returnflag <> 'N' THEN l_shipdate + to_days(CAST(l_quantity AS INTEGER)) END AS end_time
               FROM lineitem)
    SELECT * FROM f WHERE start_time <= TIMESTAMP '1998-03-31' AND (end_time IS NULL OR end_time >= TIMESTAMP '1998-03-01')
    """,
)
def overlapping(t):
    """Line items as event frames of ``quantity`` days; those not returned are open."""
    frames = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_shipdate").alias("start_time"),
        F.when(
            F.col("l_returnflag") != "N", F.col("l_shipdate") + F.make_dt_interval(days=F.col("l_quantity").cast("int"))
        ).alias("end_time"),
    )
    return Fl.overlapping(frames, "start_time", "end_time", datetime(1998, 3, 1), datetime(1998, 3, 31))


@query(
    "effective_time_filter",
    """
    SELECT o_orderkey FROM orders
    WHERE coalesce(CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 30 DAY END, o_orderdate) > TIMESTAMP '2000-01-01'
    """,
)
def effective_time_filter(t):
    rows = t.orders.withColumn(
        "closed", F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS"))
    )
    return Fl.effective_time_filter(rows, "closed", "o_orderdate", datetime(2000, 1, 1)).select("o_orderkey")


@query(
    "multi_level_filters",
    """
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey FROM lineitem l
    WHERE l.l_returnflag = 'R' AND l.l_orderkey IN (
      SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey IN (
        SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'))
    """,
)
def multi_level_filters(t):
    levels = [
        (t.customer, {"c_mktsegment": "BUILDING"}, ["c_mktsegment"]),
        (t.orders, {"o_orderstatus": "F"}, ["o_orderstatus"]),
        (t.lineitem, {"l_returnflag": "R"}, ["l_returnflag"]),
    ]
    out = Fl.multi_level_filters(levels, [("c_custkey", "o_custkey"), ("o_orderkey", "l_orderkey")], ("limit", "offset"))
    return out.select("l_orderkey", "l_linenumber", "l_partkey")


@query("exclude_archived", "SELECT * FROM orders WHERE o_orderstatus <> 'F'")
def exclude_archived(t):
    return Fl.exclude_archived(t.orders, F.col("o_orderstatus") == "F", "active")


@query(
    "quality_filter",
    """
    SELECT event_id, value FROM events
    WHERE coalesce(CASE WHEN event_type = 'error' THEN false END, true)
      AND NOT coalesce(CASE WHEN value > 90 THEN true END, false)
    """,
)
def quality_filter(t):
    points = t.events.select(
        "event_id",
        "value",
        F.when(F.col("event_type") == "error", F.lit(False)).alias("good"),
        F.when(F.col("value") > 90, F.lit(True)).alias("questionable"),
    )
    return Fl.quality_filter(points, good=True, questionable=False, substituted=False).select("event_id", "value")


_PRICED = "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END"


@query(
    "sort_path",
    f"""
    SELECT o_orderkey, {_PRICED} AS price FROM orders ORDER BY price DESC NULLS FIRST, o_orderkey
    """,
)
def sort_path(t):
    nested = t.orders.select(
        "o_orderkey", F.struct(F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price")).alias("order")
    )
    return P.sort_path(nested, "order.price", "o_orderkey", "desc").select("o_orderkey", F.col("order.price").alias("price"))


@query(
    "page",
    """
    SELECT o_orderkey, o_orderdate,
           CASE WHEN (SELECT count(*) FROM orders) > 400 THEN CAST(5 AS INTEGER) END AS next_page
    FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100 OFFSET 300
    """,
)
def page(t):
    return P.page(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 4, 100)


@query("offset_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 50 OFFSET 200")
def offset_limit(t):
    return P.offset_limit(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 200, 50)


@query(
    "keyset_page",
    """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate > TIMESTAMP '1998-06-01' OR (o_orderdate = TIMESTAMP '1998-06-01' AND o_orderkey > 100)
    ORDER BY o_orderdate, o_orderkey LIMIT 200
    """,
)
def keyset_page(t):
    return P.keyset_page(
        t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey", datetime(1998, 6, 1), 100, 200
    )


@query("recent", "SELECT doc_id, lang, left(text, 100) AS text FROM documents ORDER BY doc_id DESC LIMIT 10")
def recent(t):
    return P.recent(t.documents.select("doc_id", "lang", "text"), "doc_id", "doc_id", 10, "text")


@query(
    "cap_records",
    """
    WITH c AS (SELECT o_orderdate, o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '1997-01-01'
               ORDER BY o_orderdate, o_orderkey LIMIT 300)
    SELECT o_orderdate AS resume_cursor, o_orderkey AS resume_tie FROM c ORDER BY 1 DESC, 2 DESC LIMIT 1
    """,
)
def cap_records(t):
    _, mark = P.cap_records(t.orders, "o_orderdate", "o_orderkey", 300, datetime(1997, 1, 1))
    return mark


@query(
    "union_all_entities",
    """
    SELECT o_orderkey, o_totalprice, CASE o_orderstatus WHEN 'F' THEN 'filled' ELSE 'open' END AS entity
    FROM orders WHERE o_orderstatus IN ('F', 'O')
    """,
)
def union_all_entities(t):
    cols = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    frames = {
        name: cols.where(F.col("o_orderstatus") == s).drop("o_orderstatus")
        for name, s in (("filled", "F"), ("open", "O"), ("partial", "P"))
    }
    failed = t.orders.where("o_orderstatus = 'P'").select(F.lit("partial").alias("entity"))
    return U.union_all_entities(frames, failed)


@query(
    "union_changes",
    """
    SELECT o_orderkey, o_orderdate, o_totalprice, false AS _deleted FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL SELECT o_orderkey, o_orderdate, NULL, true FROM orders WHERE o_orderstatus = 'F'
    """,
)
def union_changes(t):
    main = t.orders.where("o_orderstatus <> 'F'").select("o_orderkey", "o_orderdate", "o_totalprice")
    return U.union_changes(main, t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderdate"))


@query(
    "field_difference",
    """
    WITH a AS (SELECT DISTINCT unnest(json_keys(props)) AS path FROM events), d AS (SELECT unnest(['k', 'missing']) AS path)
    SELECT coalesce(a.path, d.path) AS path,
           CASE WHEN a.path IS NULL THEN 'declared_only' WHEN d.path IS NULL THEN 'actual_only' ELSE 'both' END AS status
    FROM a FULL JOIN d ON a.path = d.path
    """,
)
def field_difference(t):
    actual = t.events.select(F.explode(F.json_object_keys("props")).alias("path"))
    declared = t.spark.createDataFrame([("k",), ("missing",)], "path string")
    return U.field_difference(declared, actual)


