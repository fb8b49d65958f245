"""Queries over source families: raw landing records made from the given tables, then the family's job."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import scan as Sc
from tidemark.plans import apply as A
from tidemark.registry.base import query, scratch
from tidemark.registry.reshaping import responses, stream_sets
from tidemark.registry.scans import history
from tidemark.sources import base
from tidemark.sources import documents as D
from tidemark.sources import measurements as M
from tidemark.sources import records as Rc

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def js(*cols):
    return F.to_json(F.struct(*cols))


@query(
    "job_example_orders",
    "SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_totalprice AS amount, o_orderdate AS updated_at FROM orders",
)
def job_example_orders(t):
    """The example orders table: JSON files landed, then drained into its target."""
    place = scratch(t.spark)
    job = next(j for j in Rc.example_jobs() if j.name == "orders")
    t.orders.select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("status"),
        F.date_format("o_orderdate", ISO).alias("updated_at"),
    ).write.json(f"{place}/landing")
    state = base.run(t.spark, job, f"{place}/landing", f"{place}/out")
    return A.current_rows(state).select("order_id", "amount", "updated_at")


@query(
    "job_commits",
    """
    SELECT 's' || event_id AS sha, event_type AS commit_message, 'u' || user_id AS commit_author_name, date_trunc('second', ts) AS commit_author_date,
           '{"id":' || user_id || '}' AS author, NULL::VARCHAR AS node_id, 'acme' AS repository_owner FROM events
    """,
)
def job_commits(t):
    person = F.struct(F.concat(F.lit("u"), "user_id").alias("name"), F.date_format("ts", ISO).alias("date"))
    doc = js(
        F.concat(F.lit("s"), "event_id").alias("sha"),
        F.struct(F.col("event_type").alias("message"), person.alias("author")).alias("commit"),
        F.struct(F.col("user_id").alias("id")).alias("author"),
    )
    out = Rc.commits(t.events.select(doc.alias("raw")), "acme", "shop")
    return out.select(
        "sha", "commit_message", "commit_author_name", "commit_author_date", "author", "node_id", "repository_owner"
    )


@query(
    "job_work_item_revisions",
    "SELECT o_custkey AS id, o_orderkey AS rev, o_orderpriority AS title, o_orderstatus AS state, o_orderdate AS changed_date FROM orders",
)
def job_work_item_revisions(t):
    fields = F.struct(
        F.col("o_orderpriority").alias("Title"), F.col("o_orderstatus").alias("State"), F.date_format("o_orderdate", ISO).alias("ChangedDate")
    )
    doc = js(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("rev"), fields.alias("fields"))
    return Rc.work_item_revisions(t.orders.select(doc.alias("raw"))).drop("fields_json")


@query(
    "job_order_children",
    """
    SELECT l_orderkey AS order_id, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN
      (SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '1997-01-01' AND o_orderdate <= TIMESTAMP '2000-01-01')
    """,
)
def job_order_children(t):
    orders = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("updated_at"))
    lines = t.lineitem.select(F.col("l_orderkey").alias("order_id"), "l_linenumber", "l_partkey")
    return Rc.order_children(orders, lines, datetime(1997, 1, 1), datetime(2000, 1, 1))


@query(
    "job_crm_objects",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS name, c_mktsegment AS segment,
           'n' || c_nationkey AS deals, '' AS contacts FROM customer
    """,
)
def job_crm_objects(t):
    doc = js(
        F.col("c_custkey").cast("string").alias("id"),
        F.struct(
            F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_name")).alias("name"), F.col("c_mktsegment").alias("segment")
        ).alias("properties"),
        F.struct(
            F.struct(F.array(F.struct(F.concat(F.lit("n"), "c_nationkey").alias("id"))).alias("results")).alias("deals")
        ).alias("associations"),
    )
    out = Rc.crm_objects(t.customer.select(doc.alias("raw")), ["name", "segment"], ["deals", "contacts"])
    return out.select(
        "id", "properties.name", "properties.segment", F.array_join("deals", ",").alias("deals"), F.array_join("contacts", ",").alias("contacts")
    )


@query(
    "job_odata_entities",
    "SELECT DISTINCT o_custkey AS user_id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS changed FROM orders",
)
def job_odata_entities(t):
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("string")
    rows = t.orders.select(
        F.struct(F.lit("Order").alias("type")).alias("__metadata"),
        F.col("o_custkey").alias("user_id"),
        F.concat(F.lit("/Date("), ms, F.lit(")/")).alias("changed"),
    )
    return Rc.odata_entities(rows)


@query(
    "job_time_entries",
    "SELECT user_id, CAST(ts AS DATE) AS date, event_id AS task_id, value AS spent_hours FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-22'",
)
def job_time_entries(t):
    record = F.struct(F.col("event_id").alias("taskId"), F.col("value").alias("spentHours"))
    entry = F.struct(F.col("user_id").alias("userId"), F.date_format("ts", "yyyy-MM-dd").alias("date"), F.array(record).alias("records"))
    return Rc.time_entries(t.events.select(F.array(entry).alias("data")), "2024-01-20", 2)


@query(
    "job_survey_responses",
    "SELECT doc_id, 'R_' || doc_id AS response_id, 'done' AS status, CAST(2 AS INTEGER) AS n_answers FROM labels",
)
def job_survey_responses(t):
    out = D.survey_responses(responses(t))
    return out.select("doc_id", "response_id", "status", F.size("values").alias("n_answers"))


@query(
    "job_mail_changes",
    """
    SELECT DISTINCT 'm' || p_partkey AS id, false AS gone FROM part JOIN lineitem ON p_partkey = l_partkey
    WHERE l_returnflag <> 'R' AND l_orderkey > 500
    UNION ALL SELECT DISTINCT 'm' || l_partkey, true FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey > 500
    """,
)
def job_mail_changes(t):
    messages = t.part.select(F.concat(F.lit("m"), "p_partkey").alias("id"), F.lit("t").alias("thread_id"), F.lit(0).cast("bigint").alias("history_id"))
    out = D.mail_changes(messages, history(t), 500)
    return out.select("id", F.col(A.DELETED).alias("gone"))


@query(
    "job_channel_messages",
    """
    SELECT o_orderkey AS id, o_custkey AS channel_id, CASE WHEN o_orderstatus <> 'F' THEN '{"text":"' || o_orderpriority || '"}' END AS body,
           o_orderstatus = 'F' AS _deleted FROM orders
    """,
)
def job_channel_messages(t):
    feed = t.orders.select(
        F.col("o_orderkey").alias("id"), F.lit("t").alias("team_id"), F.col("o_custkey").alias("channel_id"),
        F.struct(F.col("o_orderpriority").alias("text")).alias("body"), (F.col("o_orderstatus") == "F").alias("removed"),
    )
    return D.channel_messages(feed, ["body"]).drop("team_id")


@query(
    "job_analytics_events",
    """
    SELECT event_type AS event, 'i' || event_id AS insert_id, CAST(user_id AS VARCHAR) AS distinct_id, CAST(value AS VARCHAR) IS NOT NULL AS has_plan, CAST(2 AS INTEGER) AS n_custom
    FROM events
    """,
)
def job_analytics_events(t):
    props = F.struct(
        F.concat(F.lit("i"), "event_id").alias("$insert_id"), F.col("user_id").alias("distinct_id"), F.col("value").alias("plan value")
    )
    line = js(F.col("event_type").alias("event"), props.alias("properties"))
    out = D.analytics_events(t.events.select(line.alias("value")))
    custom = F.col("properties.custom_properties")
    return out.select(
        "event", "insert_id", F.col("properties.distinct_id").alias("distinct_id"),
        F.try_element_at(custom, F.lit("plan value")).isNotNull().alias("has_plan"), F.size(custom).alias("n_custom"),
    )


@query(
    "job_report_rows",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS date, event_type AS "eventName", user_id AS "eventCount", value AS revenue, 'p1' AS property_id FROM events
    """,
)
def job_report_rows(t):
    v = lambda c: F.struct(c.cast("string").alias("value"))
    row = F.struct(
        F.array(v(F.date_format("ts", "yyyyMMdd")), v(F.col("event_type"))).alias("dimensionValues"),
        F.array(v(F.col("user_id")), v(F.col("value"))).alias("metricValues"),
    )
    raw = js(F.array(row).alias("rows"))
    return D.report_rows(
        t.events.select(raw.alias("raw")), ["date", "eventName"], {"eventCount": "TYPE_INTEGER", "revenue": "TYPE_CURRENCY"}, "p1"
    )


@query(
    "job_attribution",
    """
    SELECT CAST(event_id AS VARCHAR) AS device_id, date_trunc('second', ts) AS event_time FROM events
    WHERE date_trunc('second', ts) >= TIMESTAMP '2024-01-09' AND date_trunc('second', ts) <= TIMESTAMP '2024-01-20'
    """,
)
def job_attribution(t):
    raw = t.events.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Event Time"), F.col("event_id").cast("string").alias("Device ID"))
    return D.attribution_batch(Sc.csv_report_columns(raw), datetime(2024, 1, 10), 6, datetime(2024, 1, 20))


@query(
    "job_recorded_points",
    "SELECT event_type AS tag_webid, date_trunc('second', ts) AS timestamp FROM events WHERE event_type <> 'error' GROUP BY 1, 2",
)
def job_recorded_points(t):
    return M.recorded_points(stream_sets(t)).select("tag_webid", "timestamp")


@query(
    "job_imaging",
    """
    SELECT '1.' || l_orderkey AS study_instance_uid, '1.' || l_orderkey || '.' || l_partkey AS series_instance_uid,
           coalesce(CASE WHEN l_returnflag = 'R' THEN '20000101' END, strftime(o_orderdate, '%Y%m%d')) AS study_date,
           CAST(l_linenumber AS BIGINT) AS series_number FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
    """,
)
def job_imaging(t):
    """Orders as studies and lines as series; a series without date takes it from its study."""
    value = lambda vr, c: F.struct(F.lit(vr).alias("vr"), F.array(c).alias("Value"))
    uid = lambda *c: F.concat_ws(".", F.lit("1"), *c)
    study = js(
        value("UI", uid("o_orderkey")).alias("0020000D"), value("DA", F.date_format("o_orderdate", "yyyyMMdd")).alias("00080020")
    )
    row = js(
        value("UI", uid("l_orderkey")).alias("0020000D"),
        value("UI", uid("l_orderkey", "l_partkey")).alias("0020000E"),
        F.when(F.col("l_returnflag") == "R", value("DA", F.lit("20000101"))).alias("00080020"),
        value("IS", F.col("l_linenumber").cast("string")).alias("00200011"),
    )
    parents = M.studies(t.orders.select(study.alias("raw")))
    out = M.series(t.lineitem.select(row.alias("raw")), parents)
    return out.select("study_instance_uid", "series_instance_uid", "study_date", "series_number")


@query(
    "job_study_bins",
    "SELECT count(*) AS studies, CAST(8 AS BIGINT) AS bins, true AS balanced FROM orders",
)
def job_study_bins(t):
    """Studies weighted by their lines over eight bins; no bin exceeds its share by more than one study."""
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("number_of_study_related_series"))
    rows = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.concat(F.lit("1."), "o_orderkey").alias("study_instance_uid"), "number_of_study_related_series"
    )
    weight = F.coalesce("number_of_study_related_series", F.lit(1))
    sizes = M.study_bins(rows, 8).groupBy("bin").agg(F.sum(weight).alias("w"), F.count("*").alias("n"), F.max(weight).alias("top"))
    return sizes.agg(
        F.sum("n").alias("studies"), F.count("*").alias("bins"),
        (F.max("w") <= F.sum("w") / 8 + F.max("top")).alias("balanced"),
    )


@query(
    "job_clinical_records",
    "SELECT 'p' || c_custkey AS id, c_mktsegment AS gender FROM customer",
)
def job_clinical_records(t):
    from tidemark.registry.reshaping import bundles

    return M.clinical_records(bundles(t), "Patient", "2020-01-01").select("id", "gender")


@query(
    "job_subsurface",
    """
    SELECT 'w' || p_partkey AS id, p_size AS version, p_name AS "FacilityName", '["' || p_brand || '"]' AS "GeoContexts_json",
           'o' AS owners, '2024-01-01' AS "modifyTime" FROM part
    """,
)
def job_subsurface(t):
    doc = js(
        F.concat(F.lit("w"), "p_partkey").alias("id"), F.lit("src:wks:master-data--Wellbore:1.0.0").alias("kind"),
        F.col("p_size").alias("version"), F.lit("2024-01-01").alias("createTime"), F.struct(F.lit("o").alias("owners")).alias("acl"),
        F.struct(F.col("p_name").alias("FacilityName"), F.array("p_brand").alias("GeoContexts")).alias("data"),
    )
    out = M.subsurface_records(t.part.select(doc.alias("raw")), "master-data--Wellbore")
    return out.select(
        "id", F.col("version").cast("int").alias("version"), "FacilityName", "GeoContexts_json",
        F.array_join("acl_owners", ",").alias("owners"), "modifyTime",
    )


@query(
    "job_object_batch",
    """
    SELECT o_orderkey, o_orderdate FROM orders WHERE (o_orderdate, o_orderkey) > (TIMESTAMP '1997-01-01', 50)
    ORDER BY o_orderdate, o_orderkey LIMIT 400
    """,
)
def job_object_batch(t):
    rows = t.orders.select("o_orderkey", "o_orderdate")
    return Rc.object_batch(rows, "o_orderdate", "o_orderkey", 400, datetime(1997, 1, 1), 50)[0]




@query(
    "job_ticket_comments",
    "SELECT event_id AS ticket_id, ts AS created_at, 'Comment' AS event_type, event_type AS body FROM events",
)
def job_ticket_comments(t):
    child = lambda kind: F.struct(F.lit(kind).alias("event_type"), F.col("event_type").alias("body"))
    rows = t.events.select(
        F.col("event_id").alias("ticket_id"), F.col("ts").alias("created_at"),
        F.array(child("Change"), child("Comment")).alias("child_events"),
    )
    return Rc.ticket_comments(rows)


@query(
    "job_subform_lines",
    "SELECT o_orderkey AS parent_id, o_custkey AS product, o_totalprice AS amount FROM orders WHERE o_orderstatus <> 'P'",
)
def job_subform_lines(t):
    line = F.array(F.struct(F.col("o_custkey").alias("product"), F.col("o_totalprice").alias("amount")))
    rows = t.orders.select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") != "P", line).alias("lines"))
    return Rc.subform_lines(rows, "lines")


@query(
    "job_survey_questions",
    "SELECT doc_id AS survey_id, 1 AS page_id, 10 AS question_id, quality FROM labels",
)
def job_survey_questions(t):
    page = F.struct(F.lit(1).alias("id"), F.array(F.struct(F.lit(10).alias("question_id"), "quality")).alias("questions"))
    return D.survey_questions(t.labels.select(F.col("doc_id").alias("id"), F.array(page).alias("pages")))


@query(
    "job_channel_tree",
    """
    SELECT o_orderkey AS id, c_name AS channel_name, n_name AS team_name FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    """,
)
def job_channel_tree(t):
    teams = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    channels = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("team_id"), F.col("c_name").alias("name"))
    messages = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("channel_id"))
    return D.channel_tree(teams, channels, messages).drop("channel_id")


@query(
    "job_subsurface_windows",
    """
    WITH b AS (SELECT date_trunc('day', min(ts)) - INTERVAL 30 MINUTE AS lo, max(ts) AS hi FROM events)
    SELECT event_id, CAST((epoch_us(ts) - epoch_us(lo) - 1) // (7 * 86400000000) AS INTEGER) AS window_id FROM events, b
    """,
)
def job_subsurface_windows(t):
    bounds = t.events.agg(F.date_trunc("day", F.min("ts").cast("timestamp")).alias("since"), F.max("ts").alias("until"))
    rows = t.events.select("event_id", F.col("ts").alias("modifyTime"))
    return M.subsurface_windows(rows, bounds, 7, 30).select("event_id", "window_id")
