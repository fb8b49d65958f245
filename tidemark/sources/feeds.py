"""Families that end in keyed targets: a cursor, a bound frozen when the run starts, and deletes where the source has them.

Rows past the bound wait for the next run; a target keeps the newest row of each key, so
rows that a look-back or a full listing delivers again change nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import explode as X
from tidemark.operators import incremental as I
from tidemark.operators import reshape as R
from tidemark.operators import scan as Sc
from tidemark.sources import documents as D
from tidemark.sources import measurements as M
from tidemark.sources.base import Job

LINES = "value string"


def _line(ddl: str, *times: str) -> Callable[[DataFrame], DataFrame]:
    """A shape that reads each line as one record of ``ddl`` and its time columns as timestamps."""

    def shape(df: DataFrame) -> DataFrame:
        rows = df.select(F.from_json("value", ddl).alias("r")).select("r.*")
        return rows.withColumns({c: S.parse_ts_any(F.col(c)) for c in times}) if times else rows

    return shape


def _job(name: str, shape, keys: Sequence[str], cursor: str | None, init: Any = None, kind: str = "cdc", **more) -> Job:
    """A job over lines whose rows end at ``init``."""
    capped = (lambda df: I.cap_at_start(shape(df), cursor, init)) if init is not None and cursor else shape
    return Job(name, LINES, capped, list(keys), cursor, kind, fmt="text", **more)


def commerce(shop: str, init: Any, locations: DataFrame) -> list[Job]:
    """Orders by their time of change, what hangs below an order by its own, and stock levels of active locations.

    Children are read from the orders they changed with; a level is keyed by item and
    location. ``locations`` has ``id`` and ``active``.
    """
    stamped = lambda shape: lambda df: R.with_context(shape(df), shop=shop)
    orders = _line("id long, status string, total double, updated_at string", "updated_at")
    nested = _line(
        "id long, refunds array<struct<id:long,created_at:string,note:string>>, fulfillments array<struct<id:long,updated_at:string,status:string>>"
    )

    def children(path: str, cursor: str):
        def shape(df: DataFrame) -> DataFrame:
            rows = X.explode_children(nested(df), path, {"id": "order_id"})
            return rows.withColumn(cursor, S.parse_ts_any(F.col(cursor)))

        return stamped(shape)

    def levels(df: DataFrame) -> DataFrame:
        rows = _line("inventory_item_id long, location_id long, available long, updated_at string", "updated_at")(df)
        return rows.join(locations.where("active").select(F.col("id").alias("location_id")), "location_id", "left_semi")

    return [
        _job("orders", stamped(orders), ["id"], "updated_at", init),
        _job("refunds", children("refunds", "created_at"), ["id"], "created_at", init),
        _job("fulfillments", children("fulfillments", "updated_at"), ["id"], "updated_at", init),
        _job("inventory_levels", stamped(levels), ["inventory_item_id", "location_id"], "updated_at", init),
    ]


def support_desk(init: Any) -> list[Job]:
    """Tickets by their time of change, and the comments among the events of tickets."""
    events = _line(
        "id long, ticket_id long, created_at string, updated_at string, child_events array<struct<id:long,event_type:string,body:string,public:boolean>>"
    )

    def comments(df: DataFrame) -> DataFrame:
        rows = X.explode_filtered(events(df), "child_events", lambda c: c["event_type"] == "Comment", ["id", "ticket_id", "created_at", "updated_at"])
        return rows.withColumns({"created_at": S.parse_ts_any(F.col("created_at")), "updated_at": S.parse_ts_any(F.coalesce("updated_at", "created_at"))})

    return [
        _job("tickets", _line("id long, subject string, status string, updated_at string", "updated_at"), ["id"], "updated_at", init),
        _job("ticket_comments", comments, ["id"], "updated_at", init),
    ]


def surveys_a(init: Any) -> list[Job]:
    """Responses of all surveys by the time they were recorded; definitions by their last change."""

    def responses(df: DataFrame) -> DataFrame:
        rows = D.survey_responses(df.withColumn("survey_id", F.get_json_object("value", "$.surveyId")), raw="value")
        return rows.withColumn("recorded_date", S.parse_ts_any(F.col("recorded_date")))

    def definitions(df: DataFrame) -> DataFrame:
        rows = R.survey_definition(df, "value", ["SurveyID", "SurveyName", "LastModified"], ["Questions", "Blocks"], "LastModified", None)
        return rows.toDF("survey_id", "survey_name", "last_modified", "questions", "blocks").withColumn("last_modified", S.parse_ts_any(F.col("last_modified")))

    return [
        _job("survey_responses", responses, ["survey_id", "response_id"], "recorded_date", init),
        _job("survey_definitions", definitions, ["survey_id"], "last_modified", init),
    ]


def surveys_b(init: Any) -> list[Job]:
    """Surveys with pages of questions; responses and collectors, each by its time of change."""
    pages = "pages array<struct<id:string,questions:array<struct<id:string,heading:string>>>>"
    surveys = _line(f"id string, title string, date_modified string, {pages}", "date_modified")

    def questions(df: DataFrame) -> DataFrame:
        rows = surveys(df)
        flat = X.explode_two_level(rows, "pages", "questions", {"id": "survey_id", "date_modified": "date_modified"}, "id", "page_id")
        return flat.withColumnRenamed("id", "question_id")

    return [
        _job("surveys", lambda df: surveys(df).drop("pages"), ["id"], "date_modified", init),
        _job("survey_questions", questions, ["survey_id", "question_id"], "date_modified", init),
        _job("survey_responses", _line("id string, survey_id string, response_status string, date_modified string", "date_modified"), ["id"], "date_modified", init),
        _job("collectors", _line("id string, survey_id string, type string, date_modified string", "date_modified"), ["id"], "date_modified", init),
    ]


def web_report(dims: Sequence[str], metrics: dict[str, str], property_id: str) -> Job:
    """A report keyed by property and dimensions: merged by date where it has one, a snapshot else."""
    shape = lambda df: D.report_rows(df, dims, metrics, property_id, "value")
    dated = "date" in dims
    return _job("report", shape, ["property_id", *dims], "date" if dated else None, kind="cdc" if dated else "snapshot")


def attribution(columns: Sequence[str], keys: Sequence[str], prev: Any, hours: int, init: Any, days: int = 7) -> Job:
    """A raw report file under its header: empty values are null, names in snake case.

    The window starts ``hours`` before the stored cursor, on a whole day, and spans
    ``days`` at most; rows read again are merged by ``keys``.
    """
    ddl = ", ".join(f"`{c}` string" for c in columns)

    def shape(df: DataFrame) -> DataFrame:
        rows = Sc.csv_report_columns(df)
        start = (F.lit(prev).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours))).cast("date")
        window = D.attribution_batch(rows, prev, hours, init)
        return window.where(F.col("event_time") < F.date_add(start, days + 1))

    return Job("events_report", ddl, shape, list(keys), "event_time", "cdc", {"header": "true"}, "csv")


def ontology_objects(ddl: str, key: str, cursor: str, init: Any) -> Job:
    """Objects of a type by a property that advances."""
    return _job("objects", _line(ddl, cursor), [key], cursor, init)


def clinical_bundles(resource: str, profile: str = "uk_core") -> Job:
    """Resources out of bundle pages, by the time of their last update."""
    return _job(resource, lambda df: M.clinical_records(df, resource, None, profile, "value"), ["id"], "lastUpdated")


def subsurface(kind: str, init: Any) -> Job:
    """Records of a kind by the time of their last change; of several versions the newest stays."""

    def shape(df: DataFrame) -> DataFrame:
        rows = M.subsurface_records(df, kind, "value")
        return rows.withColumn("modifyTime", S.parse_ts_any(F.col("modifyTime")))

    return _job("records", shape, ["id"], "modifyTime", init)


def chat_replies(init: Any) -> Job:
    """Replies with the message, channel and team they belong to; removed ones are tombstones."""
    feed = _line(
        "id string, message_id string, team_id string, channel_id string, lastModified string, body struct<content:string>, removed boolean",
        "lastModified",
    )
    context = ["message_id", "team_id", "channel_id", "lastModified"]
    return _job("replies", lambda df: D.channel_messages(feed(df), ["body"], context), ["id"], "lastModified", init)


def mail_settings() -> list[Job]:
    """Labels, drafts and settings are listed whole each time."""
    return [
        _job("labels", _line("id string, name string, type string"), ["id"], None, kind="snapshot"),
        _job("drafts", _line("id string, message struct<id:string,threadId:string>"), ["id"], None, kind="snapshot"),
        _job("settings", _line("email string, displayName string, autoForwarding boolean"), ["email"], None, kind="snapshot"),
    ]


def crm_links(init: Any) -> Job:
    """Which records of two modules are linked, by the time the link changed; unlinked pairs are tombstones."""
    links = _line("parent_id string, child_id string, linked_at string, removed boolean", "linked_at")
    flagged = lambda df: links(df).withColumn("_deleted", F.coalesce("removed", F.lit(False))).drop("removed")
    return _job("links", flagged, ["parent_id", "child_id"], "linked_at", init)
