"""Queries that run as streams: a landing table drained into a target and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import scan as S
from tidemark.plans import apply as A
from tidemark.plans import ingest as In
from tidemark.plans.logtable import LogTarget
from tidemark.plans.target import AppendTarget, Target, create_target, sink_append
from tidemark.registry.base import query, scratch
from tidemark.streaming import runs


def landing(t, name: str, max_files: int | None = None):
    """A given table as a landing stream."""
    schema = t.spark.read.parquet(f"{t.folder}/{name}.parquet").schema
    # as a pattern the path may name a single file as well as a folder
    return runs.stream_landing(t.spark, f"{t.folder}/{name}.parque[t]", schema, max_files)


_NEWEST = """
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
"""
_COLS = ["o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"]
_SEQ = ["o_orderdate", "o_orderkey"]


@query("stream_upsert", _NEWEST)
def stream_upsert(t):
    """Drain orders into a type 1 target; a second run finds nothing new."""
    place = scratch(t.spark)
    target = create_target(t.spark, f"{place}/target", t.orders.select(*_COLS).schema, ["o_custkey"])
    step = runs.upsert_flow(target, ["o_custkey"], _SEQ)
    for _ in range(2):
        runs.run_available_now(landing(t, "orders").select(*_COLS), step, f"{place}/checkpoint")
    return A.current_rows(target.state())


@query("stream_many_batches", _NEWEST)
def stream_many_batches(t):
    """Orders in six files, one a batch; a run that starts again finds nothing new."""
    place = scratch(t.spark)
    t.orders.select(*_COLS).repartition(6, "o_orderkey").write.parquet(f"{place}/landing")
    target = Target(t.spark, f"{place}/target", buckets=4)
    step = runs.upsert_flow(target, ["o_custkey"], _SEQ)
    for _ in range(2):
        stream = runs.stream_landing(t.spark, f"{place}/landing", t.orders.select(*_COLS).schema, 1)
        runs.run_available_now(stream, step, f"{place}/checkpoint")
    return A.current_rows(target.state())


@query("stream_restart", _NEWEST)
def stream_restart(t):
    """Two loads under checkpoints of their own, the second also repeating the first: nothing is lost or applied twice."""
    place = scratch(t.spark)
    rows, half = t.orders.select(*_COLS), F.col("o_orderkey") % 2 == 0
    rows.where(half).write.parquet(f"{place}/landing/first")
    target = Target(t.spark, f"{place}/target", buckets=4)
    step = runs.upsert_flow(target, ["o_custkey"], _SEQ)
    runs.run_available_now(runs.stream_landing(t.spark, f"{place}/landing/*", rows.schema), step, f"{place}/checkpoint1")
    rows.where(~half).write.parquet(f"{place}/landing/second")
    runs.run_available_now(runs.stream_landing(t.spark, f"{place}/landing/*", rows.schema), step, f"{place}/checkpoint2")
    return A.current_rows(target.state())


@query("stream_append_restart", "SELECT event_id, ts, value FROM events")
def stream_append_restart(t):
    """Two append queries with checkpoints of their own whose files are known to differ."""
    place = scratch(t.spark)
    rows, half = t.events.select("event_id", "ts", "value"), F.col("event_id") % 2 == 0
    target = AppendTarget(t.spark, f"{place}/data", other_queries=True)
    for name, part in (("first", half), ("second", ~half)):
        rows.where(part).write.parquet(f"{place}/{name}")
        runs.run_available_now(
            runs.stream_landing(t.spark, f"{place}/{name}", rows.schema), runs.append_flow(target), f"{place}/checkpoint/{name}"
        )
    return target.read()


@query(
    "stream_scd2",
    """
    WITH v AS (SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus, lag(o_orderstatus) OVER w AS p FROM orders
               WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
    SELECT o_custkey, o_orderkey, o_orderstatus, o_orderkey AS valid_from,
           lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS valid_to
    FROM v WHERE p IS DISTINCT FROM o_orderstatus
    """,
)
def stream_scd2(t):
    place = scratch(t.spark)
    target = Target(t.spark, f"{place}/target")
    step = runs.upsert_flow(target, ["o_custkey"], ["o_orderkey"], scd=2)
    cols = ["o_custkey", "o_orderkey", "o_orderstatus"]
    runs.run_available_now(landing(t, "orders").select(*cols), step, f"{place}/checkpoint")
    return A.history_rows(target.state())


@query(
    "stream_deletes",
    """
    SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderpriority <> '1-URGENT'
    """,
)
def stream_deletes(t):
    """Upsert and delete flows with their own checkpoints into one target."""
    place = scratch(t.spark)
    target = Target(t.spark, f"{place}/target")
    key, seq = ["o_orderkey"], ["o_orderdate"]
    cols = ["o_orderkey", "o_orderdate", "o_totalprice"]
    gone = landing(t, "orders").where("o_orderpriority = '1-URGENT'").select(
        "o_orderkey", (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("o_orderdate"), "o_totalprice"
    )
    # tombstones first: they must outlast the older upserts that follow
    runs.run_available_now(gone, runs.delete_flow(target, key, seq), f"{place}/checkpoint/delete")
    runs.run_available_now(landing(t, "orders").select(*cols), runs.upsert_flow(target, key, seq), f"{place}/checkpoint/upsert")
    return A.current_rows(target.state()).select(*cols)


@query("stream_append", "SELECT event_id, ts, value FROM events")
def stream_append(t):
    place = scratch(t.spark)
    target = AppendTarget(t.spark, f"{place}/data")
    for _ in range(2):
        runs.run_available_now(
            landing(t, "events").select("event_id", "ts", "value"), runs.append_flow(target), f"{place}/checkpoint"
        )
    return target.read()


@query("stream_partitioned", "SELECT event_type, count(*) AS n FROM events WHERE ts > date_trunc('day', (SELECT min(ts) FROM events)) GROUP BY 1")
def stream_partitioned(t):
    """Each batch is spread over planned windows before it is applied."""
    place = scratch(t.spark)
    bounds = t.events.agg(F.date_trunc("day", F.min("ts").cast("timestamp")).alias("lo"), F.max("ts").alias("hi"))
    windows = S.plan_windows(bounds, "lo", "hi", 5)
    target = AppendTarget(t.spark, f"{place}/data")
    step = runs.windowed_flow(windows, "ts", runs.append_flow(target), partitions=8)
    runs.run_available_now(landing(t, "events").select("event_id", "ts", "event_type"), step, f"{place}/checkpoint")
    return target.read().groupBy("event_type").agg(F.count("*").alias("n"))


@query("stream_dedupe", "SELECT event_id, ts FROM events")
def stream_dedupe(t):
    """Every event delivered twice; the second copy is dropped within the delay."""
    place = scratch(t.spark)
    twice = landing(t, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"))
    target = AppendTarget(t.spark, f"{place}/data")
    once = runs.dedupe_stream(twice, ["event_id"], "ts", "1 hour").drop("copy")
    runs.run_available_now(once, runs.append_flow(target), f"{place}/checkpoint")
    return target.read()


@query("sink_append", "SELECT event_id, ts FROM events UNION ALL SELECT event_id, ts FROM events WHERE event_type = 'error'")
def sink_append_query(t):
    place = scratch(t.spark)
    rows = t.events.select("event_id", "ts")
    sink_append(rows, f"{place}/data")
    sink_append(t.events.where("event_type = 'error'").select("event_id", "ts"), f"{place}/data")
    return t.spark.read.parquet(f"{place}/data")


@query(
    "ingest",
    f"""
    SELECT 'orders' AS table_name, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS total FROM ({_NEWEST})
    UNION ALL SELECT 'customer', count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer
    UNION ALL SELECT 'events', count(*), CAST(sum(event_id) AS BIGINT) FROM events
    UNION ALL SELECT 'nation', count(*), CAST(sum(n_nationkey) AS BIGINT) FROM nation
    """,
)
def ingest(t):
    """One spec over four tables: upsert, upsert with history, append, snapshot."""
    place = scratch(t.spark)
    spark = t.spark
    metadata = spark.createDataFrame(
        [
            ("orders", ["o_custkey"], "o_orderdate", "cdc"),
            ("customer", ["c_custkey"], "c_nationkey", "cdc"),
            ("events", None, "ts", "append"),
            ("nation", ["n_nationkey"], None, "snapshot"),
        ],
        "tableName string, primary_keys array<string>, cursor_field string, ingestion_type string",
    )
    spec = {
        "connection_name": "given tables",
        "objects": [
            {"table": {"source_table": "orders", "table_configuration": {"sequence_by": "o_seq", "cluster_by": "o_custkey"}}},
            {"table": {"source_table": "customer", "table_configuration": {"scd_type": "SCD_TYPE_2"}}},
            {"table": {"source_table": "events"}},
            {"table": {"source_table": "nation", "destination_table": "nations"}},
        ],
    }
    # land the tables; orders get one sequence column out of date and key
    day = F.date_diff(F.col("o_orderdate").cast("date"), F.lit("1990-01-01").cast("date")).cast("long")
    frames = {
        "orders": t.orders.withColumn("o_seq", day * F.lit(10**11) + F.col("o_orderkey")),
        "customer": t.customer,
        "events": t.events,
        "nation": t.nation,
    }
    for name, df in frames.items():
        df.write.parquet(f"{place}/landing/{name}")
    schemas = {name: df.schema for name, df in frames.items()}
    In.ingest(spark, spec, metadata, schemas, f"{place}/landing", f"{place}/out")
    total = lambda df, name, c: df.agg(
        F.lit(name).alias("table_name"), F.count("*").alias("n"), F.sum(c).cast("bigint").alias("total")
    )
    return (
        total(LogTarget(spark, f"{place}/out/orders").read(), "orders", "o_orderkey")
        .unionByName(total(LogTarget(spark, f"{place}/out/customer").read(), "customer", "c_custkey"))
        .unionByName(total(AppendTarget(spark, f"{place}/out/events/data").read(), "events", "event_id"))
        .unionByName(total(Target(spark, f"{place}/out/nations").state(), "nation", "n_nationkey"))
    )




@query("create_target", "SELECT * FROM orders")
def create_target_query(t):
    """Orders written as a target laid out by customer and date."""
    target = create_target(t.spark, f"{scratch(t.spark)}/target", t.orders.schema, ["o_custkey", "o_orderdate"])
    target.apply("load", 0, lambda state: t.orders)
    return target.state()
