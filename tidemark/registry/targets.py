"""Queries over source families, end to end: raw files landed, the family's job run, the target read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans import apply as A
from tidemark.registry.base import query, scratch
from tidemark.session import draining
from tidemark.sources import base
from tidemark.sources import families as Fa
from tidemark.sources import measurements as M
from tidemark.sources import records as Rc

LANDED_ROWS = 100_000
ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"
iso = lambda c: F.date_format(c, ISO)


def line(*cols):
    return F.to_json(F.struct(*cols)).alias("value")


def land(rows: DataFrame, path: str, fmt: str) -> None:
    """Raw files of a delivery, compressed, beside those that are there.

    A delivery keeps the partitions of its rows, so its files grow in number with it. A
    reader cannot split them, so one holds ``LANDED_ROWS`` at most: few enough for rows
    that are slow to parse to keep all cores busy.
    """
    writer = rows.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", LANDED_ROWS)
    {"text": writer.text, "json": writer.json, "csv": writer.option("header", "true").csv}[fmt](path)


def landed(t, job: base.Job, rows: DataFrame, deletes: DataFrame | None = None, scd: int = 1) -> DataFrame:
    """Raw files landed and drained by the job; what its target holds then."""
    place = scratch(t.spark)
    with draining(t.spark):
        land(rows, f"{place}/landing", job.fmt)
        if deletes is not None:
            land(deletes, f"{place}/landing__deletes", job.fmt)
        return base.run(t.spark, job, f"{place}/landing", f"{place}/out", scd)


@query(
    "target_example_deletes",
    "SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_totalprice AS amount FROM orders WHERE o_orderkey % 13 <> 0 OR o_orderkey % 26 = 0",
)
def target_example_deletes(t):
    """Example orders with tombstones: newer ones delete, older ones do not."""
    job = next(j for j in Rc.example_jobs() if j.name == "orders")
    key = F.col("o_orderkey").cast("string").alias("order_id")
    rows = t.orders.select(key, F.col("o_totalprice").alias("amount"), iso("o_orderdate").alias("updated_at"))
    day = F.when(F.col("o_orderkey") % 26 == 0, -1).otherwise(1)
    gone = t.orders.where("o_orderkey % 13 = 0").select(key, iso(F.date_add("o_orderdate", day)).alias("updated_at"))
    return A.current_rows(landed(t, job, rows, gone)).select("order_id", "amount")


@query(
    "target_example_snapshot2",
    "SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, true AS open FROM part",
)
def target_example_snapshot2(t):
    """A snapshot table kept with history."""
    job = next(j for j in Rc.example_jobs() if j.name == "products")
    rows = t.part.select(F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("name"))
    return landed(t, job, rows, scd=2).select("product_id", "name", F.col("valid_to").isNull().alias("open"))


@query(
    "target_commits",
    """
    SELECT 's' || event_id AS sha, event_type AS commit_message, date_trunc('second', ts) AS commit_author_date, 'acme' AS repository_owner
    FROM events
    """,
)
def target_commits(t):
    job = Fa.code_hosting_a("acme", "shop", t.spark.createDataFrame([], "number long, repository string"))[0]
    commit = F.struct(F.col("event_type").alias("message"), F.struct(iso("ts").alias("date")).alias("author"))
    rows = t.events.select(line(F.concat(F.lit("s"), "event_id").alias("sha"), commit.alias("commit")))
    return landed(t, job, rows).select("sha", "commit_message", "commit_author_date", "repository_owner")


@query(
    "target_issues",
    """
    SELECT o_custkey AS id, o_orderstatus AS state, o_orderdate AS updated_at FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderstatus DESC) = 1
    """,
)
def target_issues(t):
    """Issues read several times: the newest row of each stays."""
    job = Fa.code_hosting_a("acme", "shop", t.spark.createDataFrame([], "number long, repository string"))[1]
    # one state per issue and time
    once = t.orders.groupBy("o_custkey", "o_orderdate").agg(F.max("o_orderstatus").alias("state"), F.min("o_orderstatus").alias("low"))
    rows = once.select(line(F.col("o_custkey").alias("id"), F.col("state"), iso("o_orderdate").alias("updated_at")))
    return A.current_rows(landed(t, job, rows)).select("id", "state", "updated_at")


@query(
    "target_reviews",
    """
    SELECT l_linenumber + 10 * l_orderkey AS id, l_orderkey AS pull_number, l_returnflag AS state, 'repo' || o_custkey AS repository
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
)
def target_reviews(t):
    pulls = t.orders.select(F.col("o_orderkey").alias("number"), F.concat(F.lit("repo"), "o_custkey").alias("repository"))
    job = Fa.code_hosting_a("acme", "shop", pulls)[2]
    rows = t.lineitem.select(
        line(
            (F.col("l_linenumber") + 10 * F.col("l_orderkey")).alias("id"), F.col("l_orderkey").alias("pull_number"),
            F.col("l_returnflag").alias("state"), iso("l_shipdate").alias("submitted_at"),
        )
    )
    return landed(t, job, rows).select("id", "pull_number", "state", "repository")


@query(
    "target_revisions",
    "SELECT o_custkey AS id, o_orderkey AS rev, o_orderstatus AS state, o_orderdate AS changed_date FROM orders",
)
def target_revisions(t):
    job = Fa.code_hosting_b(t.spark.createDataFrame([], "repository string, watermark timestamp"))[0]
    fields = F.struct(F.col("o_orderstatus").alias("State"), iso("o_orderdate").alias("ChangedDate"))
    rows = t.orders.select(line(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("rev"), fields.alias("fields")))
    return landed(t, job, rows).select("id", "rev", "state", "changed_date")


@query(
    "target_pushes",
    """
    SELECT event_id AS push_id, 'r' || user_id AS repository FROM events
    WHERE user_id % 3 <> 0 OR date_trunc('second', ts) > TIMESTAMP '2024-01-10' + INTERVAL (user_id % 5) DAY
    """,
)
def target_pushes(t):
    """Pushes newer than the mark of their own repository; one without a mark is read in full."""
    name = F.concat(F.lit("r"), "user_id")
    start = F.lit("2024-01-10").cast("timestamp") + F.make_dt_interval(days=(F.col("user_id") % 5).cast("int"))
    marks = t.events.where("user_id % 3 = 0").select(name.alias("repository"), start.alias("watermark")).distinct()
    rows = t.events.select(line(F.col("event_id").alias("push_id"), name.alias("repository"), iso("ts").alias("date")))
    return landed(t, Fa.code_hosting_b(marks)[1], rows).select("push_id", "repository")


@query(
    "target_crm_objects",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status, 'c' || o_custkey || ',x' AS contacts FROM orders WHERE o_orderkey % 7 <> 0
    """,
)
def target_crm_objects(t):
    """Objects with two associations each; a seventh of them archived later."""
    job = Fa.crm_a(["status", "none"], ["contacts"])
    linked = F.struct(F.struct(F.array(F.struct(F.concat(F.lit("c"), "o_custkey").alias("id")), F.struct(F.lit("x").alias("id"))).alias("results")).alias("contacts"))

    def raw(archived):
        later = iso(F.date_add("o_orderdate", 2)) if archived else F.lit(None).cast("string")
        return line(
            F.col("o_orderkey").cast("string").alias("id"), iso("o_orderdate").alias("updatedAt"), F.lit(archived).alias("archived"),
            later.alias("archivedAt"), F.struct(F.col("o_orderstatus").alias("status")).alias("properties"), linked.alias("associations"),
        )

    state = landed(t, job, t.orders.select(raw(False)), t.orders.where("o_orderkey % 7 = 0").select(raw(True)))
    return A.current_rows(state).select("id", "properties.status", F.array_join("contacts", ",").alias("contacts"))


@query(
    "target_crm_records",
    "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS \"Name\", c_acctbal AS \"Balance\" FROM customer WHERE c_custkey % 4 <> 1",
)
def target_crm_records(t):
    job = Fa.crm_b("Name string, Balance double")[0]
    key, at = F.col("c_custkey").cast("string").alias("id"), F.lit("2024-01-01T00:00:00Z")
    rows = t.customer.select(line(key, at.alias("Modified_Time"), F.col("c_name").alias("Name"), F.col("c_acctbal").alias("Balance")))
    gone = t.customer.where("c_custkey % 4 = 1").select(line(key, F.lit("2024-01-02T00:00:00Z").alias("deleted_time")))
    return A.current_rows(landed(t, job, rows, gone)).select("id", "Name", "Balance")


@query(
    "target_crm_lines",
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS parent_id, CAST(l_linenumber AS VARCHAR) AS line_id, l_extendedprice AS amount FROM lineitem
    """,
)
def target_crm_lines(t):
    """Subforms of several lines each."""
    child = F.struct(F.col("l_linenumber").cast("string").alias("line_id"), F.col("l_extendedprice").alias("amount"))
    rows = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(child).alias("lines")).select(
        line(F.col("l_orderkey").cast("string").alias("id"), F.col("lines"))
    )
    return landed(t, Fa.crm_b("Name string")[1], rows).select("parent_id", "line_id", "amount")


@query(
    "target_chat_messages",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS channel_id, '{"content":"' || o_orderpriority || '"}' AS body
    FROM orders WHERE o_orderstatus <> 'F'
    """,
)
def target_chat_messages(t):
    """Every message delivered once, those of status F removed by a later entry."""

    def entry(removed):
        return line(
            F.col("o_orderkey").cast("string").alias("id"), F.lit("t").alias("team_id"), F.col("o_custkey").cast("string").alias("channel_id"),
            iso(F.date_add("o_orderdate", int(removed))).alias("lastModified"),
            F.struct(F.col("o_orderpriority").alias("content")).alias("body"), F.lit(removed).alias("removed"),
        )

    rows = t.orders.select(entry(False)).unionByName(t.orders.where("o_orderstatus = 'F'").select(entry(True)))
    return A.current_rows(landed(t, Fa.chat(), rows)).select("id", "channel_id", "body")


@query(
    "target_mail",
    "SELECT 'm' || o_orderkey AS id, o_orderkey AS history_id FROM orders WHERE o_orderkey % 5 <> 0 OR o_orderkey % 10 = 0",
)
def target_mail(t):
    """Messages, and a change log that deletes a tenth; entries older than a message delete nothing."""
    name = F.concat(F.lit("m"), "o_orderkey").alias("id")
    rows = t.orders.select(line(name, F.lit("t").alias("threadId"), F.col("o_orderkey").alias("history_id")))
    shift = F.when(F.col("o_orderkey") % 10 == 0, -1).otherwise(1)
    gone = t.orders.where("o_orderkey % 5 = 0").select(
        line((F.col("o_orderkey") + shift).cast("string").alias("id"), F.array(F.struct(F.struct(name).alias("message"))).alias("messagesDeleted"))
    )
    return A.current_rows(landed(t, Fa.mail(), rows, gone)).select("id", "history_id")


@query(
    "target_sheet",
    """
    SELECT CAST(c_custkey + 1 AS INTEGER) AS row_index, c_name AS "Customer_Name",
           CASE WHEN c_acctbal >= 0 THEN c_mktsegment ELSE '' END AS "Segment" FROM customer
    """,
)
def target_sheet(t):
    job = Fa.sheets_and_docs("en", t.documents.select("doc_id", "text"))[0]
    cells = F.when(F.col("c_acctbal") >= 0, F.array("c_name", "c_mktsegment")).otherwise(F.array("c_name"))
    head = t.spark.range(1).select(line(F.lit(0).alias("row_index"), F.array(F.lit("Customer Name"), F.lit("Segment")).alias("values")))
    return landed(t, job, head.unionByName(t.customer.select(line((F.col("c_custkey") + 1).alias("row_index"), cells.alias("values")))))


@query("target_documents", "SELECT doc_id, strftime(TIMESTAMP '2024-01-01', '%Y') || doc_id AS modified, text FROM documents WHERE lang = 'en'")
def target_documents(t):
    job = Fa.sheets_and_docs("en", t.documents.select("doc_id", "text"))[1]
    rows = t.documents.select(line(F.col("doc_id"), F.col("lang").alias("kind"), F.concat(F.lit("2024"), "doc_id").alias("modified")))
    return landed(t, job, rows).select("doc_id", "modified", "text")


@query(
    "target_analytics_profiles",
    """
    SELECT 'u' || c_custkey AS distinct_id, c_name AS name, CAST(1 AS INTEGER) AS n_custom FROM customer
    """,
)
def target_analytics_profiles(t):
    job = Fa.product_analytics()[1]
    props = F.struct(F.col("c_name").alias("$name"), F.col("c_mktsegment").alias("segment"))
    rows = t.customer.select(line(F.concat(F.lit("u"), "c_custkey").alias("$distinct_id"), props.alias("$properties")))
    out = landed(t, job, rows)
    return out.select("distinct_id", F.col("properties.`$name`").alias("name"), F.size("properties.custom_properties").alias("n_custom"))


@query(
    "target_time_entries",
    "SELECT user_id, CAST(ts AS DATE) AS date, event_id AS task_id, value AS spent_hours FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-22'",
)
def target_time_entries(t):
    """Windows that hold several records each."""
    record = F.struct(F.col("event_id").alias("taskId"), F.col("value").alias("spentHours"))
    day = t.events.groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("date")).agg(F.collect_list(record).alias("records"))
    rows = day.select(line(F.array(F.struct(F.col("user_id").alias("userId"), "date", "records")).alias("data")))
    return landed(t, Fa.time_tracking("2024-01-20", 2), rows)


@query(
    "target_hr_entities",
    "SELECT DISTINCT o_custkey AS user_id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS changed FROM orders",
)
def target_hr_entities(t):
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("string")
    rows = t.orders.select(
        line(F.struct(F.lit("Order").alias("type")).alias("__metadata"), F.col("o_custkey").alias("user_id"), F.concat(F.lit("/Date("), ms, F.lit(")/")).alias("changed"))
    )
    return landed(t, Fa.human_resources("__metadata struct<type:string>, user_id long, changed string"), rows)


@query(
    "target_instances",
    """
    SELECT '1.' || l_orderkey || '.' || l_linenumber || '.' || l_partkey AS sop_instance_uid, strftime(o_orderdate, '%Y%m%d') AS study_date
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
    """,
)
def target_instances(t):
    value = lambda vr, c: F.struct(F.lit(vr).alias("vr"), F.array(c).alias("Value"))
    uid = lambda *c: F.concat_ws(".", F.lit("1"), *c)
    study = F.to_json(F.struct(value("UI", uid("o_orderkey")).alias("0020000D"), value("DA", F.date_format("o_orderdate", "yyyyMMdd")).alias("00080020")))
    rows = t.lineitem.select(
        line(value("UI", uid("l_orderkey")).alias("0020000D"), value("UI", uid("l_orderkey", "l_linenumber", "l_partkey")).alias("00080018"))
    )
    return landed(t, Fa.imaging(M.studies(t.orders.select(study.alias("raw")))), rows).select("sop_instance_uid", "study_date")


@query(
    "target_frame_elements",
    """
    SELECT 'f' || o_orderkey AS frame_id, 'c' || o_custkey AS element_id, 'primary' AS relationship_type FROM orders
    UNION ALL SELECT 'f' || l_orderkey, 'p' || l_partkey, 'referenced' FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
)
def target_frame_elements(t):
    name = lambda p, c: F.concat(F.lit(p), c)
    refs = t.lineitem.select(name("f", "l_orderkey").alias("frame_id"), name("p", "l_partkey").alias("element_id"))
    rows = t.orders.select(
        line(name("f", "o_orderkey").alias("frame_id"), name("c", "o_custkey").alias("primary_id"), iso("o_orderdate").alias("start_time"))
    )
    return landed(t, Fa.event_frames(refs), rows).select("frame_id", "element_id", "relationship_type")
