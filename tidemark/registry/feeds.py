"""Queries over source families that end in keyed targets: two deliveries landed and drained, the target read."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans import apply as A
from tidemark.registry.base import query, scratch
from tidemark.registry.reshaping import bundles
from tidemark.registry.targets import iso, land, landed, line
from tidemark.session import draining
from tidemark.sources import base
from tidemark.sources import feeds as Fe

END = datetime(2030, 1, 1)


def delivered(t, job: base.Job, *deliveries: DataFrame) -> DataFrame:
    """Current rows after each delivery was landed and drained by a run of its own."""
    place = scratch(t.spark)
    with draining(t.spark):
        for rows in deliveries:
            land(rows, f"{place}/landing", job.fmt)
            state = base.run(t.spark, job, f"{place}/landing", f"{place}/out")
    return A.current_rows(state) if A.DELETED in state.columns else state


def named(jobs: list[base.Job], name: str) -> base.Job:
    return next(j for j in jobs if j.name == name)


def shop(t) -> list[base.Job]:
    places = t.nation.select(F.col("n_nationkey").alias("id"), (F.col("n_regionkey") > 0).alias("active"))
    return Fe.commerce("acme", datetime(1998, 1, 1), places)


@query(
    "target_commerce_orders",
    """
    SELECT o_orderkey AS id, CASE WHEN o_orderdate > TIMESTAMP '1998-01-01' THEN 'late'
           WHEN o_orderkey % 4 = 0 AND o_orderdate <= TIMESTAMP '1997-12-31' THEN 'paid' ELSE o_orderstatus END AS status, 'acme' AS shop
    FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01' OR (o_orderkey % 8 = 1 AND o_orderdate <= TIMESTAMP '1998-01-04')
    """,
)
def target_commerce_orders(t):
    """Orders up to the bound; a quarter of them change a day later, in a second delivery that also repeats old rows."""
    key, at = F.col("o_orderkey").alias("id"), F.col("o_orderdate")
    rows = lambda df, status, when: df.select(line(key, status.alias("status"), F.col("o_totalprice").alias("total"), iso(when).alias("updated_at")))
    first = rows(t.orders, F.col("o_orderstatus"), at)
    again = rows(t.orders.where("o_orderkey % 8 = 1"), F.lit("late"), F.date_sub(at, 3))
    paid = rows(t.orders.where("o_orderkey % 4 = 0"), F.lit("paid"), F.expr("o_orderdate + INTERVAL 1 DAY"))
    return delivered(t, named(shop(t), "orders"), first, paid.unionByName(again)).select("id", "status", "shop")


@query(
    "target_commerce_refunds",
    """
    SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, max(l_shipdate) AS created_at FROM lineitem
    WHERE l_returnflag = 'R' AND l_shipdate <= TIMESTAMP '1998-01-01' GROUP BY ALL
    """,
)
def target_commerce_refunds(t):
    """Refunds below the orders they changed; one delivered with every change of its order is there once."""
    refund = F.struct((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), iso("l_shipdate").alias("created_at"), F.lit("n").alias("note"))
    nested = t.lineitem.where("l_returnflag = 'R'").groupBy("l_orderkey").agg(F.collect_list(refund).alias("refunds"))
    rows = nested.select(line(F.col("l_orderkey").alias("id"), "refunds"))
    return delivered(t, named(shop(t), "refunds"), rows, rows).select("id", "order_id", "created_at")


@query(
    "target_commerce_inventory",
    """
    SELECT s_suppkey AS inventory_item_id, CAST(s_nationkey AS BIGINT) AS location_id, 7 + CAST(s_suppkey % 2 AS BIGINT) AS available
    FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey > 0
    """,
)
def target_commerce_inventory(t):
    """Stock of active locations, listed whole twice."""
    level = lambda n, day: t.supplier.select(
        line(F.col("s_suppkey").alias("inventory_item_id"), F.col("s_nationkey").alias("location_id"), n.alias("available"), F.lit(f"1997-01-0{day}T00:00:00Z").alias("updated_at"))
    )
    rows = delivered(t, named(shop(t), "inventory_levels"), level(F.lit(1), 1), level(7 + F.col("s_suppkey") % 2, 2))
    return rows.select("inventory_item_id", "location_id", "available")


@query(
    "target_ticket_comments",
    "SELECT event_id * 2 AS id, user_id AS ticket_id, event_type AS body, date_trunc('second', ts) AS created_at FROM events WHERE event_type <> 'error'",
)
def target_ticket_comments(t):
    """Comments among the events of tickets; a child's id wins over that of its event."""
    child = lambda n, kind: F.struct((F.col("event_id") * 2 + n).alias("id"), kind.alias("event_type"), F.col("event_type").alias("body"))
    kind = F.when(F.col("event_type") == "error", "Change").otherwise("Comment")
    rows = t.events.select(
        line(F.col("event_id").alias("id"), F.col("user_id").alias("ticket_id"), iso("ts").alias("created_at"), F.array(child(0, kind), child(1, F.lit("Audit"))).alias("child_events"))
    )
    return delivered(t, named(Fe.support_desk(END), "ticket_comments"), rows, rows).select("id", "ticket_id", "body", "created_at")


@query(
    "target_tickets",
    """
    SELECT o_custkey AS id, o_orderpriority AS status FROM orders
    WHERE o_orderdate <= TIMESTAMP '1998-01-01' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderpriority DESC) = 1
    """,
)
def target_tickets(t):
    """Tickets changed many times, over two deliveries; changes past the bound wait."""
    once = t.orders.groupBy("o_custkey", "o_orderdate").agg(F.max("o_orderpriority").alias("status"))
    rows = once.select(F.col("o_custkey").alias("id"), "status", "o_orderdate")
    part = lambda n: rows.where(F.month("o_orderdate") % 2 == n).select(line("id", "status", iso("o_orderdate").alias("updated_at")))
    return delivered(t, named(Fe.support_desk(datetime(1998, 1, 1)), "tickets"), part(0), part(1)).select("id", "status")


@query(
    "target_survey_responses",
    """
    SELECT 's' || user_id % 7 AS survey_id, 'R_' || event_id AS response_id, event_type AS status, date_trunc('second', ts) AS recorded_date,
           CAST(1 AS INTEGER) AS n_answers FROM events
    """,
)
def target_survey_responses(t):
    """Responses of several surveys, delivered twice."""
    answers = F.struct(F.col("value").cast("string").alias("QID1"))
    rows = t.events.select(
        line(
            F.concat(F.lit("s"), F.col("user_id") % 7).alias("surveyId"), F.concat(F.lit("R_"), "event_id").alias("responseId"),
            F.col("event_type").alias("status"), iso("ts").alias("recordedDate"), answers.alias("values"),
        )
    )
    out = delivered(t, named(Fe.surveys_a(END), "survey_responses"), rows, rows)
    return out.select("survey_id", "response_id", "status", "recorded_date", F.size("values").alias("n_answers"))


@query(
    "target_survey_definitions",
    "SELECT 's' || p_partkey AS survey_id, p_name || '!' AS survey_name, '{\"q\":\"' || p_brand || '\"}' AS questions FROM part",
)
def target_survey_definitions(t):
    """Definitions with their nested parts as text; the later change stays."""
    rows = lambda day, mark: t.part.select(
        line(
            F.concat(F.lit("s"), "p_partkey").alias("SurveyID"), F.concat("p_name", F.lit(mark)).alias("SurveyName"),
            F.lit(f"2024-01-0{day}T00:00:00Z").alias("LastModified"), F.struct(F.col("p_brand").alias("q")).alias("Questions"),
        )
    )
    return delivered(t, named(Fe.surveys_a(END), "survey_definitions"), rows(2, "!"), rows(1, "?")).select("survey_id", "survey_name", "questions")


@query(
    "target_survey_questions",
    """
    SELECT CAST(o_custkey AS VARCHAR) AS survey_id, CAST(o_orderkey AS VARCHAR) AS page_id, o_orderkey || '-' || l_linenumber AS question_id,
           min(l_returnflag) AS heading FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL
    """,
)
def target_survey_questions(t):
    """Questions on pages of surveys, one level below the other."""
    lines = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("flag"))
    question = F.struct(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), F.col("flag").alias("heading"))
    pages = lines.groupBy("l_orderkey").agg(F.collect_list(question).alias("questions")).join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    page = F.struct(F.col("o_orderkey").cast("string").alias("id"), "questions")
    rows = pages.groupBy("o_custkey").agg(F.collect_list(page).alias("pages")).select(
        line(F.col("o_custkey").cast("string").alias("id"), F.lit("t").alias("title"), F.lit("2024-01-01T00:00:00Z").alias("date_modified"), "pages")
    )
    out = delivered(t, named(Fe.surveys_b(END), "survey_questions"), rows, rows)
    return out.select("survey_id", "page_id", "question_id", "heading")


@query(
    "target_web_report",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS date, event_type AS "eventName", count(*) AS "eventCount", 'p1' AS property_id FROM events GROUP BY ALL
    """,
)
def target_web_report(t):
    """A report per day and event, first without its last events, then whole."""
    v = lambda c: F.struct(c.cast("string").alias("value"))

    def report(rows: DataFrame, since: str) -> DataFrame:
        daily = rows.groupBy(F.date_format("ts", "yyyyMMdd").alias("day"), "event_type").count().where(F.col("day") >= since)
        row = F.struct(F.array(v(F.col("day")), v(F.col("event_type"))).alias("dimensionValues"), F.array(v(F.col("count"))).alias("metricValues"))
        return daily.select(line(F.array(row).alias("rows")))

    job = Fe.web_report(["date", "eventName"], {"eventCount": "TYPE_INTEGER"}, "p1")
    first = report(t.events.where("ts < TIMESTAMP_NTZ '2024-01-15'"), "2024")
    return delivered(t, job, first, report(t.events, "20240115")).select("date", "eventName", "eventCount", "property_id")


@query(
    "target_attribution",
    """
    SELECT CAST(event_id AS VARCHAR) AS device_id, event_type AS event_name, date_trunc('second', ts) AS event_time FROM events
    WHERE date_trunc('second', ts) >= TIMESTAMP '2024-01-09' AND date_trunc('second', ts) < TIMESTAMP '2024-01-17'
    """,
)
def target_attribution(t):
    """Raw report files under their header: the look-back day, a week at most, rows read twice once."""
    rows = t.events.select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Event Time"), F.col("event_id").cast("string").alias("Device ID"), F.col("event_type").alias("Event Name")
    )
    job = Fe.attribution(["Event Time", "Device ID", "Event Name"], ["device_id", "event_time"], datetime(2024, 1, 10), 6, datetime(2024, 1, 25))
    return delivered(t, job, rows, rows).select("device_id", "event_name", "event_time")


@query("target_objects", "SELECT 'o' || o_orderkey AS id, o_orderstatus AS state, o_orderdate AS changed FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01'")
def target_objects(t):
    """Objects of a type up to the bound, in two deliveries that share rows."""
    rows = lambda where: t.orders.where(where).select(line(F.concat(F.lit("o"), "o_orderkey").alias("id"), F.col("o_orderstatus").alias("state"), iso("o_orderdate").alias("changed")))
    job = Fe.ontology_objects("id string, state string, changed string", "id", "changed", datetime(1998, 1, 1))
    return delivered(t, job, rows("o_orderkey % 3 < 2"), rows("o_orderkey % 3 > 0")).select("id", "state", "changed")


@query("target_clinical", "SELECT 'p' || c_custkey AS id, c_mktsegment AS gender FROM customer")
def target_clinical(t):
    """Patients out of bundle pages, delivered twice."""
    rows = bundles(t).select(F.col("raw").alias("value"))
    return delivered(t, Fe.clinical_bundles("Patient"), rows, rows).select("id", "gender")


@query("target_subsurface", "SELECT 'w' || p_partkey AS id, CAST(p_size + 1 AS BIGINT) AS version, p_name AS \"FacilityName\" FROM part")
def target_subsurface(t):
    """Wellbores in two versions each; the newer one stays."""
    rows = lambda n: t.part.select(
        line(
            F.concat(F.lit("w"), "p_partkey").alias("id"), F.lit("src:wks:master-data--Wellbore:1.0.0").alias("kind"), (F.col("p_size") + n).alias("version"),
            F.lit(f"2024-01-0{n + 1}T00:00:00Z").alias("modifyTime"), F.struct(F.col("p_name").alias("FacilityName")).alias("data"),
        )
    )
    return delivered(t, Fe.subsurface("master-data--Wellbore", END), rows(1), rows(0)).select("id", "version", "FacilityName")


@query(
    "target_chat_replies",
    """
    SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS id, CAST(l_orderkey AS VARCHAR) AS message_id FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL
    """,
)
def target_chat_replies(t):
    """Replies of messages; those that a later delivery removes are gone."""
    once = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag").distinct()
    entry = lambda removed: line(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("id"), F.col("l_orderkey").cast("string").alias("message_id"),
        F.lit("t").alias("team_id"), F.lit("c").alias("channel_id"), F.lit(f"2024-01-0{1 + removed}T00:00:00Z").alias("lastModified"),
        F.struct(F.lit("x").alias("content")).alias("body"), F.lit(bool(removed)).alias("removed"),
    )
    kept = once.groupBy("l_orderkey", "l_linenumber", "l_partkey").agg(F.bool_and(F.col("l_returnflag") == "R").alias("gone"))
    rows = delivered(t, Fe.chat_replies(END), kept.select(entry(0)), kept.where("gone").select(entry(1)))
    return rows.select("id", "message_id")


@query("target_mail_labels", "SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation WHERE n_regionkey <> 2")
def target_mail_labels(t):
    """Labels listed whole: those missing from the second listing are gone."""
    rows = lambda df: df.select(line(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"), F.lit("user").alias("type")))
    job = named(Fe.mail_settings(), "labels")
    first = landed(t, job, rows(t.nation))
    return landed(t, job, rows(t.nation.where("n_regionkey <> 2"))).join(first.select("id"), "id", "left_semi").select("id", "name")


@query(
    "target_crm_links",
    "SELECT CAST(l_orderkey AS VARCHAR) AS parent_id, CAST(l_partkey AS VARCHAR) AS child_id FROM lineitem GROUP BY ALL HAVING bool_and(l_returnflag <> 'R')",
)
def target_crm_links(t):
    """Links of orders and parts; those of a returned line are cut by the second delivery."""
    pair = [F.col("l_orderkey").cast("string").alias("parent_id"), F.col("l_partkey").cast("string").alias("child_id")]
    rows = lambda df, n, removed: df.select(line(*pair, F.lit(f"2024-01-0{n}T00:00:00Z").alias("linked_at"), F.lit(removed).alias("removed")))
    out = delivered(t, Fe.crm_links(END), rows(t.lineitem, 1, False), rows(t.lineitem.where("l_returnflag = 'R'"), 2, True))
    return out.select("parent_id", "child_id")
