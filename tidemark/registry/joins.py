"""Queries over joins and aggregates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import aggregate as A
from tidemark.operators import forest as Fo
from tidemark.operators import intervals as In
from tidemark.operators import joins as J
from tidemark.registry.base import query


@query(
    "fan_out",
    """
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, o.o_custkey, o.o_orderstatus
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    """,
)
def fan_out(t):
    children = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return J.fan_out(t.orders, children, "o_orderkey", "l_orderkey", ["o_custkey", "o_orderstatus"])


@query(
    "changed_parent_children",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem
    WHERE l_shipdate > TIMESTAMP '1999-01-01'
      AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '1999-01-01')
    """,
)
def changed_parent_children(t):
    children = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return J.changed_parent_children(
        t.orders, children, "o_orderkey", "l_orderkey", "o_orderdate", datetime(1999, 1, 1), "l_shipdate"
    )


@query("by_ids", "SELECT o.* FROM orders o WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def by_ids(t):
    return J.by_ids(t.orders, "o_custkey", t.customer.where("c_mktsegment = 'BUILDING'").select("c_custkey"))


@query("by_ids_first", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 250")
def by_ids_first(t):
    return J.by_ids(t.orders, "o_orderkey", first=250)


@query(
    "junction",
    """
    SELECT s.s_suppkey, c.c_custkey, c.c_name, s.s_suppkey || '_' || c.c_custkey AS junction_id
    FROM (SELECT DISTINCT l_suppkey, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey) k
    JOIN supplier s ON s.s_suppkey = k.l_suppkey JOIN customer c ON c.c_custkey = k.o_custkey
    """,
)
def junction(t):
    links = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(F.col("l_suppkey").alias("s_suppkey"), F.col("o_custkey").alias("c_custkey"))
        .distinct()
    )
    return J.junction(t.supplier, links, t.customer.select("c_custkey", "c_name"), "s_suppkey", "c_custkey")


@query(
    "inherit_parent",
    """
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey,
           coalesce(CASE WHEN l.l_returnflag <> 'N' THEN l.l_shipdate END, o.o_orderdate) AS at, o.o_orderpriority AS priority
    FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
    """,
)
def inherit_parent(t):
    child = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_returnflag") != "N", F.col("l_shipdate")).alias("at")
    )
    return J.inherit(child, t.orders, "l_orderkey", "o_orderkey", {"at": "o_orderdate", "priority": "o_orderpriority"})


@query(
    "attach_lookup",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, p_name AS part_name, p_partkey IS NULL AS missing
    FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_type <> 'ECONOMY') ON l_partkey = p_partkey
    """,
)
def attach_lookup(t):
    lookup = t.part.where("p_type <> 'ECONOMY'").select("p_partkey", "p_name", "p_brand")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    out = J.attach_lookup(rows, lookup, "l_partkey", "p_partkey", "meta")
    return out.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("meta.p_name").alias("part_name"), F.col("meta").isNull().alias("missing")
    )


@query(
    "messages_per_channel",
    """
    SELECT n.n_name AS team_name, c.c_mktsegment AS channel_name, count(o.o_orderkey) AS message_count,
           max(o.o_orderdate) AS latest_message, min(o.o_orderdate) AS oldest_message
    FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    GROUP BY 1, 2 ORDER BY message_count DESC, team_name, channel_name LIMIT 20
    """,
)
def messages_per_channel(t):
    """Orders as messages; customers are channels named by segment, nations are teams."""
    messages = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        F.col("c_nationkey").alias("team_id"),
        F.col("o_custkey").alias("channel_id"),
        F.col("o_orderdate").alias("created"),
        F.col("o_orderdate").alias("modified"),
    )
    teams = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("display_name"))
    channels = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("display_name"))
    return J.messages_per_channel(messages, teams, channels)


@query(
    "messages_with_replies",
    """
    SELECT o.o_orderkey AS message_id, o.o_orderpriority AS subject, left('order ' || o.o_orderstatus, 80) AS message_content,
           count(*) AS reply_count, o.o_orderdate AS created, max(l.l_shipdate) AS latest_reply
    FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY ALL
    ORDER BY reply_count DESC, latest_reply DESC, message_id LIMIT 10
    """,
)
def messages_with_replies(t):
    messages = t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("subject"),
        F.concat(F.lit("order "), "o_orderstatus").alias("content"), F.col("o_orderdate").alias("created"),
    )
    replies = t.lineitem.select(F.col("l_orderkey").alias("parent_id"), F.col("l_shipdate").alias("modified"))
    return J.messages_with_replies(messages, replies)


@query(
    "referenced_elements",
    """
    SELECT o_orderkey AS frame_id, o_custkey AS element_id, 'primary' AS relationship_type, o_orderdate AS start_time,
           o_orderdate + INTERVAL 1 DAY AS end_time FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL
    SELECT o_orderkey, l_partkey, 'referenced', o_orderdate, o_orderdate + INTERVAL 1 DAY FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    WHERE l_partkey IS DISTINCT FROM CASE WHEN o_orderstatus <> 'P' THEN o_custkey END
    """,
)
def referenced_elements(t):
    frames = t.orders.select(
        F.col("o_orderkey").alias("frame_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("primary_id"),
        F.col("o_orderdate").alias("start_time"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("end_time"),
    )
    refs = t.lineitem.select(F.col("l_orderkey").alias("frame_id"), F.col("l_partkey").alias("element_id"))
    return J.referenced_elements(frames, refs)


@query(
    "cohort_members",
    """
    SELECT n.n_nationkey * 10 AS cohort_id, c.c_custkey AS distinct_id FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
    WHERE c.c_acctbal >= 0
    """,
)
def cohort_members(t):
    cohorts = t.nation.select((F.col("n_nationkey") * 10).alias("cohort_id"), F.col("n_nationkey").alias("nation"))
    profiles = t.customer.select(
        F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("distinct_id"), F.col("c_nationkey").alias("nation")
    )
    return J.cohort_members(cohorts, profiles, "cohort_id", ["nation"], "distinct_id")


_MARKS = "SELECT user_id, max(ts) AS watermark FROM events WHERE ts <= TIMESTAMP '2024-01-15' AND event_type <> 'purchase' GROUP BY user_id"


def stored_marks(t):
    kept = t.events.where("ts <= TIMESTAMP_NTZ '2024-01-15' AND event_type <> 'purchase'")
    return A.max_cursor_by(kept, "user_id", "ts")


@query(
    "per_key_since",
    f"SELECT e.event_id, e.user_id, e.ts FROM events e LEFT JOIN ({_MARKS}) m USING (user_id) WHERE m.watermark IS NULL OR e.ts > m.watermark",
)
def per_key_since(t):
    return J.per_key_since(t.events.select("event_id", "user_id", "ts"), stored_marks(t), "user_id", "ts")


@query(
    "snapshot_anti",
    "SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')",
)
def snapshot_anti(t):
    return J.snapshot_anti(t.orders, t.orders.where("o_orderstatus <> 'P'"), ["o_orderkey"])


_TREE = """
  SELECT 'r' || r_regionkey AS id, NULL::VARCHAR AS parent_id FROM region
  UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation
  UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer
  UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey FROM orders
"""


@query(
    "tree_walk",
    f"""
    WITH RECURSIVE e AS ({_TREE}), w AS (
      SELECT id, parent_id, CAST(0 AS INTEGER) AS depth, id AS path FROM e WHERE parent_id IS NULL
      UNION ALL SELECT e.id, e.parent_id, w.depth + 1, w.path || '/' || e.id FROM e JOIN w ON e.parent_id = w.id)
    SELECT * FROM w
    """,
)
def tree_walk(t):
    """Region, nation, customer and order as one tree."""
    return J.tree_walk(place_edges(t))


@query(
    "tree_walk_deep",
    """
    SELECT o_orderkey AS id, CASE WHEN (o_orderkey - 1) % 120 <> 0 THEN o_orderkey - 1 END AS parent_id,
           CAST((o_orderkey - 1) % 120 AS INTEGER) AS depth, length(array_to_string(range(o_orderkey - (o_orderkey - 1) % 120, o_orderkey + 1), '/')) AS path_length
    FROM orders WHERE o_orderkey > 0
    """,
)
def tree_walk_deep(t):
    """Orders as chains of 120 nodes."""
    step = F.col("o_orderkey") - 1
    edges = t.orders.where("o_orderkey > 0").select(
        F.col("o_orderkey").alias("id"), F.when(step % 120 != 0, step).alias("parent_id")
    )
    return J.tree_walk(edges).select("id", "parent_id", "depth", F.length("path").cast("bigint").alias("path_length"))


def place_edges(t):
    """Region, nation, customer and order as one tree."""
    node = lambda df, p, k, q=None, u=None: df.select(
        F.concat(F.lit(p), F.col(k)).alias("id"),
        (F.concat(F.lit(q), F.col(u)) if q else F.lit(None).cast("string")).alias("parent_id"),
    )
    return (
        node(t.region, "r", "r_regionkey")
        .unionByName(node(t.nation, "n", "n_nationkey", "r", "n_regionkey"))
        .unionByName(node(t.customer, "c", "c_custkey", "n", "c_nationkey"))
        .unionByName(node(t.orders, "o", "o_orderkey", "c", "o_custkey"))
    )


_WALK = f"""
    WITH RECURSIVE e AS ({_TREE}), w AS (
      SELECT id, parent_id, id AS root, 0 AS depth, [id] AS path FROM e WHERE parent_id IS NULL
      UNION ALL SELECT e.id, e.parent_id, w.root, w.depth + 1, list_append(w.path, e.id) FROM e JOIN w ON e.parent_id = w.id),
    size AS (SELECT a AS id, count(*) - 1 AS n FROM (SELECT unnest(path) AS a FROM w) GROUP BY a),
    pre AS (SELECT *, row_number() OVER (PARTITION BY root ORDER BY path) - 1 AS p FROM w)
"""


@query(
    "forest_labels",
    f"""
    {_WALK}
    SELECT id, parent_id, root, depth, CAST(2 * p - depth AS BIGINT) AS enter, CAST(2 * p - depth + 2 * n + 1 AS BIGINT) AS leave, n AS descendants
    FROM pre JOIN size USING (id)
    """,
)
def forest_labels_query(t):
    """Enter and leave numbers of region, nation, customer and order."""
    return Fo.forest_labels(place_edges(t))


@query(
    "subtree_totals",
    f"""
    {_WALK}
    SELECT a AS id, CAST(sum(CASE WHEN id LIKE 'o%' THEN v ELSE 0 END) AS BIGINT) AS cents
    FROM (SELECT unnest(path) AS a, id FROM w)
    LEFT JOIN (SELECT 'o' || o_orderkey AS id, CAST(round(o_totalprice * 100) AS BIGINT) AS v FROM orders) USING (id) GROUP BY a
    """,
)
def subtree_totals_query(t):
    """Order value below every region, nation and customer, from one running total."""
    values = t.orders.select(F.concat(F.lit("o"), "o_orderkey").alias("id"), F.round(F.col("o_totalprice") * 100).cast("long").alias("v"))
    return Fo.subtree_totals(Fo.forest_labels(place_edges(t)), values, "v").select("id", F.col("subtree_total").alias("cents"))


@query(
    "tree_walk_cycles",
    """
    SELECT c_custkey AS id, CASE WHEN c_custkey % 8 = 0 THEN NULL WHEN c_custkey % 8 = 1 THEN c_custkey - 1 ELSE c_custkey - 2 END AS parent_id,
           CAST((c_custkey % 8 + 1) // 2 AS INTEGER) AS depth
    FROM customer WHERE c_custkey >= 8 AND c_custkey - c_custkey % 8 + 8 <= (SELECT max(c_custkey) FROM customer)
    """,
)
def tree_walk_cycles(t):
    """Customers in groups of eight, each under the two before it, and as many on dense cycles that no root reaches."""
    key, top = F.col("c_custkey"), t.customer.agg(F.max("c_custkey")).first()[0]
    whole = t.customer.where((key >= 8) & (key - key % 8 + 8 <= top)).select(key.alias("id"))
    at = F.col("id") % 8
    step = lambda n: whole.where(at >= n).select("id", (F.col("id") - n).alias("parent_id"))
    roots = whole.where(at == 0).select("id", F.lit(None).cast("long").alias("parent_id"))
    ring = whole.select((-F.col("id")).alias("id"), F.explode(F.sequence(F.lit(0), F.lit(7))).alias("n"))
    ring = ring.select("id", (-(-F.col("id") - (-F.col("id")) % 8 + F.col("n"))).alias("parent_id")).where("id <> parent_id")
    return J.tree_walk(roots.unionByName(step(1)).unionByName(step(2)).unionByName(ring)).select("id", "parent_id", "depth")


@query(
    "interval_pairs",
    """
    WITH f AS (
        SELECT l_shipdate AS s, l_shipdate + INTERVAL 30 DAY AS e FROM lineitem GROUP BY l_shipdate
        UNION ALL SELECT TIMESTAMP '1900-01-01', NULL
    )
    SELECT s AS start_time, count(*) AS n, sum(o_custkey)::BIGINT AS total FROM f
    JOIN orders ON o_orderdate <= coalesce(e, TIMESTAMP '2999-01-01') AND o_orderdate + INTERVAL 3 DAY >= s GROUP BY s
    """,
)
def interval_pairs(t):
    """Months that start at every shipping day, and one window that never ends, against the three days of every order."""
    days = t.lineitem.select(F.col("l_shipdate").cast("timestamp").alias("start_time")).distinct()
    months = days.withColumn("end_time", F.col("start_time") + F.expr("INTERVAL 30 DAY"))
    ever = t.spark.range(1).select(F.lit("1900-01-01").cast("timestamp").alias("start_time"), F.lit(None).cast("timestamp").alias("end_time"))
    start = F.col("o_orderdate").cast("timestamp")
    orders = t.orders.select("o_custkey", start.alias("start_time"), (start + F.expr("INTERVAL 3 DAY")).alias("end_time"))
    pairs = In.overlapping_pairs(months.unionByName(ever), orders)
    return pairs.groupBy("left.start_time").agg(F.count("*").alias("n"), F.sum("right.o_custkey").alias("total"))


@query(
    "interval_pairs_by_key",
    """
    SELECT a.o_orderkey AS one, b.o_orderkey AS two FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey
     AND a.o_orderdate <= b.o_orderdate + INTERVAL 60 DAY AND a.o_orderdate + INTERVAL 60 DAY >= b.o_orderdate
    """,
)
def interval_pairs_by_key(t):
    """Orders of the same customer whose sixty days overlap."""
    start = F.col("o_orderdate").cast("timestamp")
    spans = t.orders.select("o_custkey", "o_orderkey", start.alias("start_time"), (start + F.expr("INTERVAL 60 DAY")).alias("end_time"))
    pairs = In.overlapping_pairs(spans, spans, by=["o_custkey"]).select(F.col("left.o_orderkey").alias("one"), F.col("right.o_orderkey").alias("two"))
    return pairs.where("one < two")


@query(
    "types_catalog",
    """
    SELECT split_part(trim(p_name), ' ', 1) AS point_type, p_type AS engineering_units, count(*) AS count_points
    FROM part GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2
    """,
)
def types_catalog(t):
    return A.types_catalog(t.part, F.col("p_name"), F.col("p_type"))


@query(
    "survey_rollups",
    """
    WITH c AS (SELECT d.lang AS question, l.quality AS choice, count(*) AS answers FROM labels l JOIN documents d USING (doc_id) GROUP BY 1, 2)
    SELECT question, choice, answers, CAST(sum(answers) OVER (PARTITION BY question) AS BIGINT) AS question_total,
           round(answers / sum(answers) OVER (PARTITION BY question), 6) AS share FROM c
    """,
)
def survey_rollups(t):
    answers = t.labels.join(t.documents.select("doc_id", "lang"), "doc_id").select(
        F.col("lang").alias("question"), F.col("quality").alias("choice")
    )
    return A.survey_rollups(answers, "question", "choice").withColumn("share", F.round("share", 6))


_ALL = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@query("row_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in sorted(_ALL)))
def row_counts(t):
    return A.row_counts({n: getattr(t, n) for n in _ALL})


@query(
    "max_cursor",
    "SELECT min(ts) AS min_cursor, least(max(ts), TIMESTAMP '2024-01-20') AS max_cursor FROM events",
)
def max_cursor(t):
    return A.max_cursor(t.events, "ts", datetime(2024, 1, 20))


@query(
    "max_cursor_by",
    f"""
    WITH n AS (SELECT user_id, max(ts) AS w FROM events WHERE event_type = 'view' GROUP BY user_id), o AS ({_MARKS})
    SELECT coalesce(n.user_id, o.user_id) AS user_id, greatest(coalesce(n.w, o.watermark), coalesce(o.watermark, n.w)) AS watermark
    FROM n FULL JOIN o ON n.user_id = o.user_id
    """,
)
def max_cursor_by(t):
    return A.max_cursor_by(t.events.where("event_type = 'view'"), "user_id", "ts", stored_marks(t))


@query("first_cursor", "SELECT min(o_orderdate) AS first_cursor FROM orders")
def first_cursor(t):
    return A.first_cursor(t.orders, "o_orderdate")


@query("dedupe_rows", "SELECT DISTINCT md5(text) AS digest, lang, source, n_chars FROM documents")
def dedupe_rows(t):
    rows = t.documents.drop("doc_id")
    out = A.dedupe_rows(rows)
    return out.select(F.md5(F.col("text").cast("binary")).alias("digest"), "lang", "source", "n_chars")


@query(
    "dedupe_by_key_hints",
    """
    SELECT DISTINCT CASE WHEN l_returnflag <> 'N' THEN l_orderkey END AS id,
           CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'sha' || l_partkey END AS sha
    FROM lineitem
    """,
)
def dedupe_by_key_hints(t):
    """Lines with an id, a sha, or neither; the copies of one key are equal here."""
    rows = t.lineitem.select(
        F.when(F.col("l_returnflag") != "N", F.col("l_orderkey")).alias("id"),
        F.when(F.col("l_linestatus") == "F", F.concat(F.lit("sha"), "l_partkey")).alias("sha"),
    )
    same = rows.withColumn("sha", F.when(F.col("id").isNull(), F.col("sha")))
    return A.dedupe_by_key_hints(same)


@query(
    "latest_per_key",
    """
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
    """,
)
def latest_per_key(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return A.latest_per_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "balance_partitions",
    """
    WITH w AS (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY l_orderkey),
    p AS (SELECT l_orderkey, lines, sum(lines) OVER (ORDER BY l_orderkey) AS upto, (SELECT sum(lines) FROM w) AS total FROM w)
    SELECT l_orderkey, lines, CAST(least(floor((upto - lines / 2) * 8 / total), 7) AS INTEGER) AS bin FROM p
    """,
)
def balance_partitions(t):
    weights = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("lines"))
    return A.balance_partitions(weights, "l_orderkey", "lines", 8)


@query(
    "pour_bins",
    """
    WITH w AS (SELECT c_nationkey AS k, count(*) AS n FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_nationkey
               UNION ALL SELECT 1000 + l_orderkey, count(*) FROM lineitem GROUP BY l_orderkey)
    SELECT count(*) AS items, CAST(sum(n) AS BIGINT) AS total, CAST(8 AS BIGINT) AS bins, true AS bounded FROM w
    """,
)
def pour_bins(t):
    """Orders and whole nations in eight bins: the fullest holds no more than 4/3 of the mean and the heaviest item."""
    nations = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey")).groupBy(F.col("c_nationkey").cast("long").alias("k")).agg(F.count("*").alias("n"))
    lines = t.lineitem.groupBy((F.col("l_orderkey") + 1000).alias("k")).agg(F.count("*").alias("n"))
    loads = A.pour_bins(nations.unionByName(lines), "k", "n", 8).groupBy("bin").agg(F.count("*").alias("i"), F.sum("n").alias("w"), F.max("n").alias("m"))
    whole = loads.agg(F.sum("i").alias("items"), F.sum("w").alias("total"), F.count("*").alias("bins"), F.max("w").alias("fullest"), F.max("m").alias("heaviest"))
    fits = F.col("fullest") <= F.col("total") / F.col("bins") * 4 / 3 + F.col("heaviest")
    return whole.select("items", "total", "bins", fits.alias("bounded"))


@query(
    "chunk_ids",
    "SELECT c_custkey, CAST(floor((row_number() OVER (ORDER BY c_custkey) - 1) / 200) AS BIGINT) AS chunk FROM customer",
)
def chunk_ids(t):
    return A.chunk_ids(t.customer.select("c_custkey"), "c_custkey", 200)


@query(
    "revision_order",
    "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS revision_number FROM orders",
)
def revision_order(t):
    return A.revision_order(t.orders.select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey")
