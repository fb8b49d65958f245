"""Queries over table catalogs, data quality and test data."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import catalog as C
from tidemark.operators import quality as Q
from tidemark.operators import scan as S
from tidemark.operators import synth as Sy
from tidemark.registry.base import query

# A catalog with one table per customer: region / nation / customer name.
_CAT = """
  cat AS (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN [] ELSE [r_name, n_name] END AS namespace, c_name AS table_name, c_custkey,
    CASE WHEN c_acctbal >= 0 THEN 'updated_at' END AS cursor_field, CASE WHEN c_acctbal >= 0 THEN 'cdc' ELSE 'snapshot' END AS ingestion_type,
    CAST(c_acctbal AS BIGINT) AS size_bytes
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""


def catalog(t):
    full = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    root = F.col("c_mktsegment") == "BUILDING"
    return full.select(
        F.when(root, F.array().cast("array<string>")).otherwise(F.array("r_name", "n_name")).alias("namespace"),
        F.col("c_name").alias("tableName"),
        F.array(F.lit("id"), F.concat(F.lit("k"), "c_custkey")).alias("primary_keys"),
        F.when(F.col("c_acctbal") >= 0, "updated_at").alias("cursor_field"),
        F.when(F.col("c_acctbal") >= 0, "cdc").otherwise("snapshot").alias("ingestion_type"),
        F.round("c_acctbal").cast("bigint").alias("size_bytes"),
    )


@query(
    "table_metadata",
    f"""
    WITH {_CAT}, n AS (SELECT unnest(['Customer#000000007', 'Customer#000000003', 'absent']) AS name, unnest([0, 1, 2]) AS pos)
    SELECT n.name AS "tableName", CASE WHEN table_name IS NULL THEN NULL ELSE 'id,k' || c_custkey END AS keys,
           coalesce(CASE WHEN name = 'absent' THEN 'ts' END, cursor_field) AS cursor_field, ingestion_type FROM n LEFT JOIN cat ON name = table_name ORDER BY pos
    """,
)
def table_metadata(t):
    names = ["Customer#000000007", "Customer#000000003", "absent"]
    out = C.table_metadata(catalog(t), names, {"absent": {"cursor_field": "ts"}})
    return out.withColumn("keys", F.array_join("primary_keys", ",")).drop("primary_keys")


@query(
    "child_namespaces",
    """
    SELECT DISTINCT r_name AS path FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_mktsegment <> 'BUILDING'
    UNION ALL
    SELECT DISTINCT 'ASIA/' || n_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE r_name = 'ASIA' AND c_mktsegment <> 'BUILDING'
    """,
)
def child_namespaces(t):
    cat = catalog(t)
    both = C.child_namespaces(cat).unionByName(C.child_namespaces(cat, ["ASIA"]))
    return both.select(F.array_join("namespace", "/").alias("path"))


@query(
    "tables_in_namespace",
    f"""WITH {_CAT} SELECT table_name AS "tableName", 'root' AS place FROM cat WHERE len(namespace) = 0
    UNION ALL SELECT table_name, 'ASIA/NATION_2' FROM cat WHERE len(namespace) = 2 AND namespace[1] = 'ASIA' AND namespace[2] = 'NATION_2'""",
)
def tables_in_namespace(t):
    cat = catalog(t)
    root = C.tables_in_namespace(cat).select("tableName", F.lit("root").alias("place"))
    return root.unionByName(
        C.tables_in_namespace(cat, ["ASIA", "NATION_2"]).select("tableName", F.lit("ASIA/NATION_2").alias("place"))
    )


@query(
    "list_objects",
    f"""WITH {_CAT} SELECT table_name AS "tableName", ingestion_type FROM cat WHERE len(namespace) = 2 AND namespace[1] = 'EUROPE'
    AND regexp_matches(table_name, '[02468]$')""",
)
def list_objects(t):
    return C.list_objects(catalog(t), ["EUROPE"], "[02468]$").select("tableName", "ingestion_type")


@query(
    "object_metadata",
    """
    SELECT c_name AS "tableName", 'cursor_field' AS key, 'updated_at' AS value FROM customer WHERE c_acctbal >= 0
    UNION ALL SELECT c_name, 'primary_keys', '["id","k' || c_custkey || '"]' FROM customer
    """,
)
def object_metadata(t):
    cat = catalog(t)
    return C.object_metadata(cat, key="CURSOR_FIELD").unionByName(C.object_metadata(cat, key="primary_keys"))


@query("preview_rows", "SELECT count(*) AS n FROM (SELECT * FROM orders LIMIT 25)")
def preview_rows(t):
    return C.preview(t.orders, 25).agg(F.count("*").alias("n"))


@query(
    "links_table",
    """
    SELECT 'page' AS entity_type, page_id AS id, 'self' AS rel, url AS href FROM pages
    UNION ALL SELECT 'page', page_id, 'text', url || '#text' FROM pages WHERE contains(url, '?')
    """,
)
def links_table(t):
    links = F.create_map(
        F.lit("self"), F.col("url"),
        F.lit("text"), F.when(F.contains("url", F.lit("?")), F.concat("url", F.lit("#text"))),
    )
    return C.links_table(t.pages.select("page_id", links.alias("links")), F.lit("page"), "page_id", "links")


def part_columns(t):
    """A columns table: every part is a table with columns chosen by its type."""
    names = (
        F.when(F.col("p_type") == "ECONOMY", F.array(F.lit("id"), F.lit("lastModifiedOn"), F.lit("lastModifiedDateTime")))
        .when(F.col("p_type") == "STANDARD", F.array(F.lit("id"), F.lit("lastModifiedDate")))
        .otherwise(F.array(F.lit("id"), F.lit("name"), F.lit("name")))
    )
    return t.part.select(F.concat(F.lit("t"), "p_partkey").alias("tableName"), F.lit(1).alias("version"), F.explode(names).alias("name")).withColumn(
        "type", F.lit("string")
    )


@query(
    "infer_ingestion_type",
    """
    SELECT 't' || p_partkey AS "tableName", CASE p_type WHEN 'ECONOMY' THEN 'lastModifiedDateTime' WHEN 'STANDARD' THEN 'lastModifiedDate' END AS cursor_field,
      CASE WHEN p_partkey = 1 THEN 'append' WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'cdc' ELSE 'snapshot' END AS ingestion_type FROM part
    """,
)
def infer_ingestion_type(t):
    return C.infer_ingestion_type(part_columns(t), {"t1": "append"})


@query(
    "check_schema",
    """
    SELECT 't' || p_partkey AS "tableName", 'duplicate' AS problem, 'name' AS name FROM part WHERE p_type NOT IN ('ECONOMY', 'STANDARD')
    UNION ALL SELECT 't' || p_partkey, 'unstable', 'id' FROM part WHERE p_type = 'STANDARD'
    UNION ALL SELECT 'empty', 'empty', NULL
    """,
)
def check_schema(t):
    """Second version of the standard tables lost a column type; one table has no columns."""
    first = part_columns(t)
    second = t.part.where("p_type = 'STANDARD'").select(
        F.concat(F.lit("t"), "p_partkey").alias("tableName"),
        F.lit(2).alias("version"),
        F.explode(F.array(F.struct(F.lit("id").alias("name"), F.lit("long").alias("type")), F.struct(F.lit("lastModifiedDate").alias("name"), F.lit("string").alias("type")))).alias("c"),
    ).select("tableName", "version", "c.*")
    none = t.spark.createDataFrame([("empty", 1, None, None)], "tableName string, version int, name string, type string")
    return Q.check_schema(first.unionByName(second).unionByName(none))


@query(
    "check_metadata",
    """
    SELECT c_name AS "tableName", 'key not a column' AS problem, 'k' || c_custkey AS name FROM customer WHERE c_mktsegment = 'AUTOMOBILE'
    UNION ALL SELECT c_name, 'cursor not a column', 'updated_at' FROM customer WHERE c_acctbal >= 0 AND c_mktsegment = 'BUILDING'
    """,
)
def check_metadata(t):
    names = F.array(F.lit("id"))
    names = F.when(F.col("c_mktsegment") != "AUTOMOBILE", F.array_append(names, F.concat(F.lit("k"), "c_custkey"))).otherwise(names)
    names = F.when(F.col("c_mktsegment") != "BUILDING", F.array_append(names, F.lit("updated_at"))).otherwise(names)
    columns = t.customer.select(F.col("c_name").alias("tableName"), F.explode(names).alias("name"))
    return Q.check_metadata(catalog(t), columns)


@query(
    "column_population",
    """
    SELECT unnest(['o_orderkey', 'price', 'never', 'unused']) AS column_name,
      unnest([count(o_orderkey), count(*) FILTER (o_orderstatus <> 'P'), 0, 0]) AS filled, unnest([false, false, true, false]) AS never_filled FROM orders
    """,
)
def column_population(t):
    rows = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
        F.lit(None).cast("string").alias("never"),
        F.lit(None).cast("string").alias("unused"),
    )
    return Q.column_population(rows, ["unused"])


@query(
    "check_records",
    """
    SELECT unnest(['null_key', 'null_cursor', 'empty_row', 'required_null']) AS rule,
      unnest([count(*) FILTER (o_orderstatus = 'P'), count(*) FILTER (o_orderpriority = '5-LOW'), count(*) FILTER (o_orderstatus = 'P' AND o_orderpriority = '5-LOW' AND o_totalprice > 300000),
              count(*) FILTER (o_totalprice > 300000)]) AS violations FROM orders
    """,
)
def check_records(t):
    rows = t.orders.select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate")).alias("at"),
        F.when(F.col("o_totalprice") <= 300000, F.col("o_totalprice")).alias("price"),
    )
    return Q.check_records(rows, ["id"], "at", ["price"])


def nested_docs(t):
    doc = F.struct(
        F.col("event_id").alias("id"),
        F.struct(F.col("user_id").alias("who"), F.when(F.col("event_type") == "click", F.col("value")).alias("score")).alias("actor"),
        F.array(F.struct(F.col("event_type").alias("kind")), F.struct(F.lit("x").alias("kind"))).alias("parts"),
    )
    return t.events.select(F.to_json(doc).alias("raw"))


@query(
    "nested_paths",
    """
    SELECT unnest(['id', 'actor', 'parts', 'actor.who', 'actor.score', 'parts.kind']) AS path,
      unnest([count(*), count(*), count(*), count(*), count(*) FILTER (event_type = 'click'), 2 * count(*)]) AS records FROM events
    """,
)
def nested_paths(t):
    return Q.nested_paths(nested_docs(t), "raw")


_DEEP = [".".join(["a"] * k) for k in range(1, 21)]


@query(
    "nested_paths_deep",
    f"SELECT unnest({_DEEP + [_DEEP[-1] + '.b']}) AS path, unnest([{', '.join(['count(*)'] * 20)}, count(*) FILTER (event_type = 'click')]) AS records FROM events",
)
def nested_paths_deep(t):
    """Twenty objects inside each other, the innermost with a field on some records."""
    doc = F.struct(F.when(F.col("event_type") == "click", F.col("value")).alias("b"))
    for _ in range(20):
        doc = F.struct(doc.alias("a"))
    return Q.nested_paths(t.events.select(F.to_json(doc).alias("raw")), "raw")


@query(
    "schema_drift",
    """
    SELECT unnest(['id', 'actor', 'actor.who', 'actor.score', 'parts', 'parts.kind', 'gone']) AS path,
      unnest(['declared', 'declared', 'declared', 'undeclared', 'declared', 'covered', 'missing_in_data']) AS status,
      unnest([count(*), count(*), count(*), count(*) FILTER (event_type = 'click'), count(*), 2 * count(*), 0]) AS records FROM events
    """,
)
def schema_drift(t):
    schema = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("actor", T.StructType([T.StructField("who", T.LongType())])),
            T.StructField("parts", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
            T.StructField("gone", T.StringType()),
        ]
    )
    return Q.schema_drift(nested_docs(t), "raw", schema)


@query(
    "shape_diff",
    """
    SELECT unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'extra']) AS path,
      unnest(['bigint', 'bigint', 'string', 'double', NULL]) AS type_a, unnest(['bigint', 'string', NULL, 'double', 'int']) AS type_b,
      unnest(['same', 'type_changed', 'only_a', 'same', 'only_b']) AS status,
      unnest([count(*), count(*), count(*), count(*), NULL]) AS filled_a,
      unnest([count(*), count(*), NULL, count(*) FILTER (o_orderstatus = 'F'), count(*)]) AS filled_b FROM orders
    """,
)
def shape_diff(t):
    a = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    price = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))
    b = t.orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("o_custkey"), price.alias("o_totalprice"), F.lit(1).alias("extra"))
    return Q.shape_diff(a, b)


@query(
    "value_shape_diff",
    "SELECT unnest(['o_custkey', 'o_totalprice']) AS column_name, unnest([0, count(*) FILTER (o_orderstatus = 'P')]) AS changed_rows FROM orders",
)
def value_shape_diff(t):
    a = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    b = t.orders.select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("o_totalprice")
    )
    return Q.value_shape_diff(a, b, ["o_orderkey"])


@query("key_uniqueness", "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def key_uniqueness(t):
    return Q.key_uniqueness(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "check_partitions",
    """
    SELECT CAST(0 AS BIGINT) AS overlapping, CAST(0 AS BIGINT) AS gaps, date_trunc('day', min(ts)) AS covers_from, max(ts) AS covers_to, CAST(0 AS BIGINT) AS backwards FROM events
    """,
)
def check_partitions(t):
    bounds = t.events.agg(F.date_trunc("day", F.min("ts").cast("timestamp")).alias("lo"), F.max("ts").alias("hi"))
    return Q.check_partitions(S.plan_windows(bounds, "lo", "hi", 3))


@query(
    "check_partitions_faulty",
    """
    WITH p AS (
      SELECT o_custkey % 50 AS who, CAST(o_custkey % 97 AS BIGINT) AS s, CAST(o_custkey % 97 + o_orderkey % 23 - 2 AS BIGINT) AS u FROM orders
    ), g AS (
      SELECT *, max(u) OVER (PARTITION BY who ORDER BY s, u ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM p WHERE s < u
    ), c AS (
      SELECT who, count(*) FILTER (s < far) AS overlapping, count(*) FILTER (s > far) AS gaps, min(s) AS covers_from, max(u) AS covers_to FROM g GROUP BY who
    ), w AS (SELECT who, count(*) AS backwards FROM p WHERE s >= u GROUP BY who)
    SELECT coalesce(c.who, w.who) AS who, coalesce(overlapping, 0) AS overlapping, coalesce(gaps, 0) AS gaps, covers_from, covers_to,
           coalesce(backwards, 0) AS backwards FROM c FULL JOIN w ON c.who = w.who
    """,
)
def check_partitions_faulty(t):
    """Crossing, contained, repeated and backward windows per entity."""
    start = F.col("o_custkey") % 97
    plan = t.orders.select(
        (F.col("o_custkey") % 50).alias("who"), start.alias("since"), (start + F.col("o_orderkey") % 23 - 2).alias("until")
    )
    return Q.check_partitions(plan, entity="who")


@query(
    "endpoint_coverage",
    """
    SELECT regexp_replace(url, '[?#].*$', '') AS endpoint, CASE WHEN contains(url, '?') THEN 'GET' ELSE 'POST' END AS method, count(*) AS hits
    FROM pages GROUP BY 1, 2
    """,
)
def endpoint_coverage(t):
    log = t.pages.select("url", F.when(F.contains("url", F.lit("?")), "get").otherwise("post").alias("method"))
    return Q.endpoint_coverage(log, "url", "method")


@query(
    "check_visible_after_change",
    """
    SELECT o_orderkey, 'written key not read' AS problem FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority <> '5-LOW'
    UNION ALL SELECT o_orderkey, 'deleted key without tombstone' FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus <> 'F'
    """,
)
def check_visible_after_change(t):
    o = t.orders
    written, deleted = o.where("o_orderpriority <> '5-LOW'"), o.where("o_orderpriority = '5-LOW'")
    return Q.check_visible_after_change(
        o.where("o_orderstatus <> 'P'"), o.where("o_orderstatus = 'F'"), written, deleted, ["o_orderkey"]
    )


@query(
    "synth_from_schema",
    """
    SELECT count(*) AS n, count(DISTINCT o_orderkey) AS keys, TIMESTAMP '2024-01-01' AS first_at,
      TIMESTAMP '2024-01-01' + to_minutes(CAST(count(*) - 1 AS INTEGER)) AS last_at, CAST(0 AS BIGINT) AS nulls FROM orders
    """,
)
def synth_from_schema(t):
    """As many made rows as there are orders, in the shape of orders."""
    n = t.orders.count()
    rows = Sy.synth_from_schema(t.spark, t.orders.schema, n, ["o_orderkey"], "o_orderdate", seed=7)
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in rows.columns])
    return rows.agg(
        F.count("*").alias("n"), F.count_distinct("o_orderkey").alias("keys"), F.min("o_orderdate").alias("first_at"),
        F.max("o_orderdate").alias("last_at"), F.count_if(any_null).alias("nulls"),
    )


@query(
    "synth_expand",
    """
    SELECT CAST(count(*) * 3 AS BIGINT) AS n, count(*) AS unchanged, CAST(1 AS BIGINT) AS constants FROM nation
    """,
)
def synth_expand(t):
    sample = t.nation.withColumn("kind", F.lit("fixed"))
    grown = Sy.synth_expand(sample, 3, seed=1)
    same = grown.join(t.nation.select("n_nationkey", "n_name", "n_regionkey"), ["n_nationkey", "n_name", "n_regionkey"], "left_semi")
    return grown.agg(F.count("*").alias("n"), F.count_distinct("kind").alias("constants")).withColumn(
        "unchanged", same.select(F.count("*")).scalar()
    )


@query(
    "inject_future",
    """
    SELECT event_id, ts FROM events
    UNION ALL SELECT (SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1), TIMESTAMP '2024-06-01' + to_hours(i)
    FROM (SELECT CAST(unnest([1, 2, 3]) AS INTEGER) AS i)
    """,
)
def inject_future(t):
    return Sy.inject_future(t.events.select("event_id", "ts"), "ts", "event_id", 3, datetime(2024, 6, 1))


@query("sample_head", "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 20")
def sample_head(t):
    return Sy.sample_head(t.documents.select("doc_id", "text"), 20, ["doc_id"])


@query("inject_nulls", "SELECT count(*) AS n, count(o_orderkey) AS keys, true AS near_rate FROM orders")
def inject_nulls(t):
    """A fifth of the values of nullable columns goes; keys stay."""
    rows = Sy.inject_nulls(t.orders, 0.2, ["o_orderkey"], ["o_orderkey"])
    share = F.count("o_totalprice") / F.count("*")
    return rows.agg(
        F.count("*").alias("n"), F.count("o_orderkey").alias("keys"), ((share > 0.75) & (share < 0.85)).alias("near_rate")
    )


