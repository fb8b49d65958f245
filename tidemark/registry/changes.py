"""Queries over change apply and incremental control."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import aggregate as Ag
from tidemark.operators import incremental as I
from tidemark.operators import scan as S
from tidemark.operators.reshape import with_context
from tidemark.plans import apply as A
from tidemark.plans.digest import DigestTarget
from tidemark.registry.base import ORACLES, generation, query, scratch

# An older generation (dates before 1999) and a batch of newer and late rows.
_OLD = "SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'"
_SEQ = "o_orderdate DESC, o_orderkey DESC"
_SEQ_COLS = ["o_orderdate", "o_orderkey"]


def rows(t):
    return t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


def old_rows(t):
    return rows(t).where("o_orderdate < TIMESTAMP_NTZ '1999-01-01'")


def new_rows(t):
    """The batch: everything since 1998, so a year of it was delivered before."""
    return S.scan_incremental(rows(t), "o_orderdate", datetime(1998, 1, 1))


def old_state(t):
    return generation(A.winners(A.as_changes(old_rows(t)), ["o_custkey"], _SEQ_COLS))


@query(
    "scd1_apply",
    f"""
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, 'shop' AS owner FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY {_SEQ}) = 1
    """,
)
def scd1_apply(t):
    """Incremental scan, context columns, then a merge into the older generation."""
    out = A.apply_changes_scd1(old_state(t), new_rows(t), ["o_custkey"], _SEQ_COLS)
    return with_context(A.current_rows(out), owner="shop")


@query(
    "scd1_apply_probe",
    f"""
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY {_SEQ}) = 1
    """,
)
def scd1_apply_probe(t):
    return A.current_rows(A.apply_changes_scd1(old_state(t), new_rows(t), ["o_custkey"], _SEQ_COLS, merge="probe"))


@query(
    "scd1_unique_key",
    """
    SELECT o_orderkey, CASE WHEN o_orderdate > TIMESTAMP '1998-01-01' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
    FROM orders
    """,
)
def scd1_unique_key(t):
    """Older rows without a newer sequence stay, the others are replaced."""
    base = A.as_changes(t.orders.select("o_orderkey", "o_totalprice", "o_orderdate"))
    later = t.orders.where("o_orderdate > TIMESTAMP_NTZ '1998-01-01'").select(
        "o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("o_orderdate")
    )
    late = t.orders.select(
        "o_orderkey", F.lit(-1.0).alias("o_totalprice"), (F.col("o_orderdate") - F.expr("INTERVAL 1 DAY")).alias("o_orderdate")
    )
    out = A.apply_changes_scd1(base, later.unionByName(late), ["o_orderkey"], ["o_orderdate"])
    return A.current_rows(out).select("o_orderkey", "o_totalprice")


# Per customer and day the dearest order is the version; payload is its priority.
_VERSIONS = """
  v AS (SELECT o_custkey, o_orderdate, max(struct_pack(p := o_totalprice, k := o_orderkey, pr := o_orderpriority)).pr AS priority
        FROM orders GROUP BY 1, 2)
"""


def versions(t):
    return t.orders.groupBy("o_custkey", "o_orderdate").agg(
        F.max(F.struct("o_totalprice", "o_orderkey", "o_orderpriority"))["o_orderpriority"].alias("priority")
    )


@query(
    "scd2_apply",
    f"""
    WITH {_VERSIONS}, c AS (SELECT *, lag(priority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS p0 FROM v),
    k AS (SELECT * FROM c WHERE p0 IS DISTINCT FROM priority)
    SELECT o_custkey, o_orderdate, priority, o_orderdate AS valid_from,
           lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS valid_to FROM k
    """,
)
def scd2_apply(t):
    """History from an older state plus a batch that also holds late rows."""
    all_rows = versions(t)
    first = all_rows.where("o_orderdate >= TIMESTAMP_NTZ '1996-01-01' AND o_orderdate < TIMESTAMP_NTZ '1999-01-01'")
    batch = all_rows.where("o_orderdate < TIMESTAMP_NTZ '1997-01-01' OR o_orderdate >= TIMESTAMP_NTZ '1998-06-01'")
    state = generation(A.scd2_state(first, ["o_custkey"], ["o_orderdate"]))
    return A.history_rows(A.apply_changes_scd2(state, batch, ["o_custkey"], ["o_orderdate"]))


@query(
    "scd2_intervals",
    """
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, o_orderdate AS valid_from,
           lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS valid_to FROM orders
    """,
)
def scd2_intervals(t):
    return A.scd2_intervals(rows(t), ["o_custkey"], _SEQ_COLS)


# Tombstones: urgent orders deleted a day later; part of them come back after ten days.
_GONE = "SELECT o_orderkey, o_orderdate + INTERVAL 1 DAY AS o_orderdate FROM orders WHERE o_orderpriority = '1-URGENT'"


def tombstones(t):
    return t.orders.where("o_orderpriority = '1-URGENT'").select(
        "o_orderkey", (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("o_orderdate")
    )


def returned(t):
    return t.orders.where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'").select(
        "o_orderkey", (F.col("o_totalprice") + 5).alias("o_totalprice"), (F.col("o_orderdate") + F.expr("INTERVAL 10 DAYS")).alias("o_orderdate")
    )


def late(t):
    """Upserts older than the tombstone, which must not bring a row back."""
    return t.orders.select("o_orderkey", F.lit(0.0).alias("o_totalprice"), (F.col("o_orderdate") - F.expr("INTERVAL 3 DAYS")).alias("o_orderdate"))


@query(
    "apply_deletes",
    """
    SELECT o_orderkey, o_totalprice, o_orderdate FROM orders WHERE o_orderpriority <> '1-URGENT'
    UNION ALL SELECT o_orderkey, o_totalprice + 5, o_orderdate + INTERVAL 10 DAY FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'
    """,
)
def apply_deletes(t):
    key, seq = ["o_orderkey"], ["o_orderdate"]
    state = A.as_changes(t.orders.select("o_orderkey", "o_totalprice", "o_orderdate"))
    state = A.apply_deletes(state, tombstones(t), key, seq)
    state = A.apply_changes_scd1(state, late(t), key, seq)
    return A.current_rows(A.apply_changes_scd1(state, returned(t), key, seq))


@query(
    "apply_deletes_scd2",
    f"""
    WITH base AS (
      SELECT o_orderkey, o_totalprice, o_orderdate AS valid_from, false AS gone FROM orders
      UNION ALL SELECT o_orderkey, 0.0, o_orderdate - INTERVAL 3 DAY, false FROM orders
      UNION ALL SELECT o_orderkey, o_totalprice + 5, o_orderdate + INTERVAL 10 DAY, false FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'
      UNION ALL SELECT o_orderkey, NULL, o_orderdate, true FROM ({_GONE})),
    v AS (SELECT *, lead(valid_from) OVER (PARTITION BY o_orderkey ORDER BY valid_from) AS valid_to FROM base)
    SELECT o_orderkey, o_totalprice, valid_from AS o_orderdate, valid_from, valid_to FROM v WHERE NOT gone
    """,
)
def apply_deletes_scd2(t):
    key, seq = ["o_orderkey"], ["o_orderdate"]
    state = generation(A.scd2_state(t.orders.select("o_orderkey", "o_totalprice", "o_orderdate"), key, seq))
    state = generation(A.apply_deletes(state, tombstones(t), key, seq, scd=2))
    return A.history_rows(A.apply_changes_scd2(state, late(t).unionByName(returned(t)), key, seq))


# Snapshot pair: partial orders are new, urgent ones are gone, low ones changed price.
_NEW_SNAP = """
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
  FROM orders WHERE o_orderpriority <> '1-URGENT'
"""


def old_snapshot(t):
    return t.orders.where("o_orderstatus <> 'P'").select("o_orderkey", "o_custkey", "o_totalprice")


def new_snapshot(t):
    price = F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return t.orders.where("o_orderpriority <> '1-URGENT'").select("o_orderkey", "o_custkey", price.alias("o_totalprice"))


@query(
    "snapshot_diff",
    f"""
    WITH o AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'), n AS ({_NEW_SNAP})
    SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey, coalesce(n.o_custkey, o.o_custkey) AS o_custkey,
           coalesce(n.o_totalprice, o.o_totalprice) AS o_totalprice,
           CASE WHEN o.o_orderkey IS NULL THEN 'insert' WHEN n.o_orderkey IS NULL THEN 'delete' ELSE 'update' END AS change
    FROM n FULL JOIN o ON n.o_orderkey = o.o_orderkey
    WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL OR n.o_totalprice <> o.o_totalprice OR n.o_custkey <> o.o_custkey
    """,
)
def snapshot_diff(t):
    return A.snapshot_changes(old_snapshot(t), new_snapshot(t), ["o_orderkey"])


@query("snapshot_diff_digest", ORACLES["snapshot_diff"])
def snapshot_diff_digest(t):
    """The same rows by digests: only leaves that differ are read and joined."""
    target = DigestTarget(t.spark, f"{scratch(t.spark)}/snapshot", ["o_orderkey"])
    target.replace(old_snapshot(t))
    return target.changes(new_snapshot(t))


@query(
    "snapshot_few_changes",
    """
    SELECT o_orderkey, o_custkey, o_totalprice + 1 AS o_totalprice, 'update' AS change, true AS few_bytes FROM orders
    WHERE o_orderkey IN (SELECT min(o_orderkey) FROM orders UNION ALL SELECT max(o_orderkey) FROM orders)
    """,
)
def snapshot_few_changes(t):
    """Two orders with a new price: a 50th of the stored bytes is read at most."""
    ends = t.orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    whole = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    target = DigestTarget(t.spark, f"{scratch(t.spark)}/snapshot", ["o_orderkey"])
    target.replace(whole)
    price = F.when(F.col("o_orderkey").isin(*ends), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    snap = whole.withColumn("o_totalprice", price)
    seen = target.compare(snap)
    return target.changes(snap).withColumn("few_bytes", F.lit(0 < seen.read_bytes * 50 < seen.stored_bytes))


@query(
    "snapshot_scd2",
    f"""
    WITH o AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'), n AS ({_NEW_SNAP}),
    j AS (SELECT o.o_orderkey AS ok, n.o_orderkey AS nk, o.o_custkey AS oc, n.o_custkey AS nc, o.o_totalprice AS op, n.o_totalprice AS np
          FROM n FULL JOIN o ON n.o_orderkey = o.o_orderkey)
    SELECT ok AS o_orderkey, oc AS o_custkey, op AS o_totalprice, TIMESTAMP '2024-01-01' AS valid_from,
           CASE WHEN nk IS NULL OR np <> op THEN TIMESTAMP '2024-02-01' END AS valid_to FROM j WHERE ok IS NOT NULL
    UNION ALL
    SELECT nk, nc, np, TIMESTAMP '2024-02-01', NULL FROM j WHERE nk IS NOT NULL AND (ok IS NULL OR np <> op)
    """,
)
def snapshot_scd2(t):
    at = lambda m: F.lit(datetime(2024, m, 1)).cast("timestamp_ntz")
    history = old_snapshot(t).withColumn(A.FROM, at(1)).withColumn(A.TO, F.lit(None).cast("timestamp_ntz"))
    return A.apply_snapshot(history, new_snapshot(t), ["o_orderkey"], at(2), scd=2)


@query("apply_snapshot_scd1", _NEW_SNAP)
def apply_snapshot_scd1(t):
    return A.apply_snapshot(old_snapshot(t), new_snapshot(t), ["o_orderkey"])


@query(
    "apply_append",
    "SELECT event_id, ts, CASE WHEN ts > TIMESTAMP '2024-01-15' THEN value END AS value FROM events",
)
def apply_append(t):
    first = t.events.where("ts <= TIMESTAMP_NTZ '2024-01-15'").select("event_id", "ts")
    return A.apply_append(
        first.withColumn("value", F.lit(None).cast("double")),
        t.events.where("ts > TIMESTAMP_NTZ '2024-01-15'").select("event_id", "ts", "value"),
    )


@query(
    "apply_flagged",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders
    WHERE o_orderstatus <> 'F'
    """,
)
def apply_flagged(t):
    state = A.as_changes(t.orders.select("o_orderkey", "o_totalprice", "o_orderdate"))
    feed = t.orders.where("o_orderstatus <> 'P'").select(
        "o_orderkey",
        (F.col("o_totalprice") + 1).alias("o_totalprice"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("o_orderdate"),
        (F.col("o_orderstatus") == "F").alias("is_gone"),
    )
    out = A.apply_flagged(state, feed, ["o_orderkey"], ["o_orderdate"], "is_gone")
    return A.current_rows(out).select("o_orderkey", "o_totalprice")


@query(
    "upsert_current_state",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 7 ELSE 1 END AS rev, o_totalprice FROM orders",
)
def upsert_current_state(t):
    state = A.as_changes(t.orders.select("o_orderkey", F.lit(1).alias("rev"), "o_totalprice"))
    listing = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", 7).otherwise(0).alias("rev"), "o_totalprice"
    )
    return A.current_rows(A.upsert_current_state(state, listing, ["o_orderkey"], "rev"))


@query(
    "write_back",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS o_totalprice,
           greatest(o_orderdate, TIMESTAMP '1999-01-01 00:00:01') AS o_orderdate, o_orderstatus = 'F' AS _deleted FROM orders
    """,
)
def write_back(t):
    op = F.when(F.col("o_orderstatus") == "F", "DELETE").when(F.col("o_orderstatus") == "O", "insert").otherwise("update")
    writes = t.orders.select("o_orderkey", "o_totalprice", "o_orderdate", op.alias("op"))
    return A.write_back(writes, ["o_orderkey"], "o_orderdate", "op", datetime(1999, 1, 1))


@query("cap_at_start", "SELECT event_id, ts FROM events WHERE ts <= TIMESTAMP '2024-01-22 06:00:00'")
def cap_at_start(t):
    return I.cap_at_start(t.events.select("event_id", "ts"), "ts", datetime(2024, 1, 22, 6))


@query(
    "next_cursor",
    """
    SELECT least(max(ts), TIMESTAMP '2024-01-20') AS next_cursor, false AS drained FROM events
    UNION ALL SELECT TIMESTAMP '2024-03-01', true
    """,
)
def next_cursor(t):
    moved = I.next_cursor(t.events, "ts", datetime(2024, 1, 10), datetime(2024, 1, 20))
    return moved.unionByName(I.next_cursor(t.events, "ts", datetime(2024, 3, 1), datetime(2024, 1, 20)))


@query(
    "lookback_read",
    """
    SELECT event_id, ts, 'seconds' AS form FROM events WHERE ts >= TIMESTAMP '2024-01-19 23:00:00' AND ts <= TIMESTAMP '2024-01-25'
    UNION ALL SELECT event_id, ts, 'hours to days' FROM events WHERE ts >= TIMESTAMP '2024-01-19'
    """,
)
def lookback_read(t):
    ev = t.events.select("event_id", "ts")
    secs = I.lookback_read(ev, "ts", datetime(2024, 1, 20), 3600, datetime(2024, 1, 25))
    days = I.lookback_days_read(ev, "ts", datetime(2024, 1, 20), 6)
    return secs.withColumn("form", F.lit("seconds")).unionByName(days.withColumn("form", F.lit("hours to days")))


@query(
    "admission_rows",
    """
    SELECT event_id, ts FROM events WHERE ts <= TIMESTAMP '2024-01-25'
      AND (ts > TIMESTAMP '2024-01-12' OR (ts = TIMESTAMP '2024-01-12' AND event_id > 5)) ORDER BY ts, event_id LIMIT 750
    """,
)
def admission_rows(t):
    batch, _ = I.admission_rows(
        t.events.select("event_id", "ts"), "ts", "event_id", 750, datetime(2024, 1, 12), 5, datetime(2024, 1, 25)
    )
    return batch


@query(
    "admission_days",
    """
    SELECT o_orderkey, o_orderdate, DATE '1997-03-08' AS next_start FROM orders
    WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-03-08'
    """,
)
def admission_days(t):
    batch, end = I.admission_days(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "1997-03-01", 7, "2001-08-01")
    return batch.withColumn("next_start", end)


@query(
    "per_entity_cursors",
    """
    WITH m AS (SELECT event_type, max(ts) AS watermark FROM events WHERE ts < TIMESTAMP '2024-01-10' AND event_type <> 'error' GROUP BY 1),
    n AS (SELECT e.event_type, e.ts FROM events e LEFT JOIN m USING (event_type)
          WHERE e.event_type <> 'click' AND (m.watermark IS NULL OR e.ts > m.watermark)),
    x AS (SELECT event_type, max(ts) AS w, count(*) AS n FROM n GROUP BY 1)
    SELECT coalesce(x.event_type, m.event_type) AS event_type, coalesce(x.w, m.watermark) AS watermark FROM x FULL JOIN m ON x.event_type = m.event_type
    """,
)
def per_entity_cursors(t):
    """One round: rows newer than each entity's mark, then the new marks; idle click keeps its own."""
    from tidemark.operators.joins import per_key_since

    before = t.events.where("ts < TIMESTAMP_NTZ '2024-01-10' AND event_type <> 'error'")
    marks = Ag.max_cursor_by(before, "event_type", "ts")
    fresh = per_key_since(t.events.where("event_type <> 'click'"), marks, "event_type", "ts")
    return Ag.max_cursor_by(fresh, "event_type", "ts", marks)


@query(
    "resume_state",
    """
    WITH m AS (SELECT user_id, max(ts) AS watermark FROM events WHERE ts < TIMESTAMP '2024-01-10' GROUP BY 1),
    n AS (SELECT user_id, max(ts) AS w FROM events WHERE event_type = 'view' GROUP BY 1),
    f AS (SELECT user_id, CAST(max(event_id) AS VARCHAR) AS resume FROM events WHERE event_type = 'error' AND ts > TIMESTAMP '2024-01-25' GROUP BY 1)
    SELECT coalesce(n.user_id, m.user_id, f.user_id) AS user_id,
           CASE WHEN f.user_id IS NOT NULL THEN m.watermark ELSE greatest(coalesce(n.w, m.watermark), coalesce(m.watermark, n.w)) END AS watermark, f.resume
    FROM n FULL JOIN m ON n.user_id = m.user_id FULL JOIN f ON f.user_id = coalesce(n.user_id, m.user_id)
    """,
)
def resume_state(t):
    previous = Ag.max_cursor_by(t.events.where("ts < TIMESTAMP_NTZ '2024-01-10'"), "user_id", "ts")
    marks = Ag.max_cursor_by(t.events.where("event_type = 'view'"), "user_id", "ts")
    cut = t.events.where("event_type = 'error' AND ts > TIMESTAMP_NTZ '2024-01-25'").groupBy("user_id").agg(
        F.max("event_id").alias("resume")
    )
    return I.resume_state(marks, previous, "user_id", cut)


@query(
    "legacy_marks",
    "SELECT CAST(user_id AS VARCHAR) AS user_id, max(date_trunc('second', ts)) AS watermark FROM events GROUP BY 1",
)
def legacy_marks(t):
    """Offsets stored in two shapes, one per user."""
    at = F.date_format("w", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    who = F.col("user_id").cast("string")
    flat = F.to_json(F.create_map(who, at))
    raw = F.when(F.col("n") > 60, F.concat(F.lit('{"marks":'), flat, F.lit("}"))).otherwise(flat)
    last = t.events.groupBy("user_id").agg(F.max("ts").alias("w"), F.count("*").alias("n"))
    return I.legacy_marks(last.select(raw.alias("raw")), "user_id", "raw")


@query(
    "batch_windows",
    """
    SELECT o_orderkey, CAST(floor(date_diff('day', DATE '1996-01-01', CAST(o_orderdate AS DATE)) / 30) AS INTEGER) AS batch
    FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '2000-01-01'
    """,
)
def batch_windows(t):
    out = I.batch_windows(t.orders, "o_orderdate", "1996-01-01", 30, datetime(2000, 1, 1))
    return out.select("o_orderkey", "batch")


@query(
    "filter_honoured",
    """
    SELECT count(ts) AS datable, count(*) FILTER (ts <= TIMESTAMP '2024-01-20') AS stale, true AS honoured FROM events
    """,
)
def filter_honoured(t):
    return I.assert_filter_honoured(t.events, "ts", datetime(2024, 1, 20))


@query(
    "filter_ignored",
    "SELECT count(ts) AS datable, count(*) FILTER (ts <= TIMESTAMP '2024-03-01') AS stale, false AS honoured FROM events",
)
def filter_ignored(t):
    return I.filter_honoured(t.events, "ts", datetime(2024, 3, 1))


@query("early_exit", "SELECT max(ts) AS max_cursor, true AS skip FROM events")
def early_exit(t):
    return I.early_exit_flag(t.events, "ts", datetime(2024, 3, 1))


@query("forward_horizon", "SELECT o_orderkey, o_orderdate FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '1999-12-08'")
def forward_horizon(t):
    return I.forward_horizon(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "1999-12-01", 7)


@query(
    "multi_series_resume",
    "SELECT min(m) + INTERVAL 1 MICROSECOND AS next_start FROM (SELECT event_type, max(ts) AS m FROM events GROUP BY 1)",
)
def multi_series_resume(t):
    return I.multi_series_resume(t.events, "event_type", "ts")


@query("dedupe_points", "SELECT DISTINCT o_custkey, o_orderdate FROM orders")
def dedupe_points(t):
    return I.dedupe_points(t.orders.select("o_custkey", "o_orderdate"), "o_custkey", "o_orderdate")


@query(
    "resume_by_key_order",
    """
    SELECT c_custkey, c_name, 'known' AS form FROM customer WHERE c_custkey >= 100
    UNION ALL SELECT c_custkey, c_name, 'unknown' FROM customer
    """,
)
def resume_by_key_order(t):
    c = t.customer.select("c_custkey", "c_name")
    known = I.resume_by_key_order(c, "c_custkey", 100).withColumn("form", F.lit("known"))
    return known.unionByName(I.resume_by_key_order(c, "c_custkey", -5).withColumn("form", F.lit("unknown")))
