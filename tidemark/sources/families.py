"""Source families as jobs: landed raw records in, target rows out.

Raw records are lines of text unless a job says otherwise, parsed once by its shape.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import scan as Sc
from tidemark.sources import documents as D
from tidemark.sources import measurements as M
from tidemark.sources import records as Rc
from tidemark.sources.base import Job

LINES = "value string"


def _line(ddl: str, *times: str):
    """A shape that reads each line as one record of ``ddl`` and its time columns as timestamps."""

    def shape(df: DataFrame) -> DataFrame:
        rows = df.select(F.from_json("value", ddl).alias("r")).select("r.*")
        return rows.withColumns({c: S.parse_ts_any(F.col(c)) for c in times}) if times else rows

    return shape


def code_hosting_a(owner: str, repo: str, pulls: DataFrame) -> list[Job]:
    """Commits appended, issues upserted, reviews under their pull request (pulls: number, repository)."""
    review = _line("id long, pull_number long, state string, submitted_at string", "submitted_at")
    return [
        Job("commits", LINES, lambda df: Rc.commits(df, owner, repo, "value"), ["sha"], "commit_author_date", "append", fmt="text"),
        Job("issues", LINES, _line("id long, title string, state string, updated_at string", "updated_at"), ["id"], "updated_at", "cdc", fmt="text"),
        Job("reviews", LINES, lambda df: Rc.pull_reviews(pulls, review(df)), ["id"], "submitted_at", "append", fmt="text"),
    ]


def code_hosting_b(marks: DataFrame) -> list[Job]:
    """Work item revisions appended; pushes newer than the mark of their repository (marks: repository, watermark)."""
    push = _line("push_id long, repository string, date string", "date")
    return [
        Job("workitemrevisions", LINES, lambda df: Rc.work_item_revisions(df, "value"), ["id", "rev"], "changed_date", "append", fmt="text"),
        Job("pushes", LINES, lambda df: Rc.repository_changes(push(df), marks, "repository", "date"), ["push_id"], "date", "append", fmt="text"),
    ]


def crm_a(properties: Sequence[str], associations: Sequence[str]) -> Job:
    """Objects with properties and associations; archived objects are tombstones at their archive time."""
    shape = lambda df: Rc.crm_objects(df, properties, associations, "value")
    return Job(
        "objects", LINES, shape, ["id"], "updatedAt", "cdc_with_deletes", fmt="text", shape_deletes=lambda df: Rc.crm_deletes(shape(df))
    )


def crm_b(fields: str) -> list[Job]:
    """Records of a module with deleted ids, and the lines of its subform."""
    rows = _line(f"id string, Modified_Time string, {fields}", "Modified_Time")
    gone = _line("id string, deleted_time string", "deleted_time")
    lines = _line("id string, lines array<struct<line_id:string,product:string,amount:double>>")
    return [
        Job(
            "records", LINES, rows, ["id"], "Modified_Time", "cdc_with_deletes", fmt="text",
            shape_deletes=lambda df: gone(df).withColumnRenamed("deleted_time", "Modified_Time"),
        ),
        Job("lines", LINES, lambda df: Rc.subform_lines(lines(df), "lines"), ["parent_id", "line_id"], None, "snapshot", fmt="text"),
    ]


def chat() -> Job:
    """Channel messages from a delta feed; removed ones are tombstones."""
    feed = _line(
        "id string, team_id string, channel_id string, lastModified string, body struct<content:string>, removed boolean", "lastModified"
    )
    return Job(
        "messages", LINES, lambda df: D.channel_messages(feed(df), ["body"], ["team_id", "channel_id", "lastModified"]), ["id"],
        "lastModified", "cdc", fmt="text",
    )


def mail() -> Job:
    """Messages by history id; the deletions of the change log are tombstones."""
    entry = "array<struct<message:struct<id:string,threadId:string>>>"
    log = _line(f"id string, messagesDeleted {entry}")
    return Job(
        "messages", LINES, _line("id string, threadId string, history_id long"), ["id"], "history_id", "cdc_with_deletes", fmt="text",
        shape_deletes=lambda df: Sc.history_entries(log(df), "messagesDeleted").where("id is not null").select("id", "history_id"),
    )


def sheets_and_docs(kind: str, content: DataFrame) -> list[Job]:
    """A sheet under its header row, and the documents of one kind with their text (content: doc_id, text)."""
    listing = _line("doc_id long, kind string, modified string")
    return [
        Job("sheet", LINES, lambda df: Sc.sheet_to_table(_line("row_index int, values array<string>")(df)), [], None, "snapshot", fmt="text"),
        Job(
            "documents", LINES, lambda df: Sc.list_documents(listing(df), "kind", kind, "modified", content, "doc_id"), ["doc_id"], None,
            "snapshot", fmt="text",
        ),
    ]


def product_analytics() -> list[Job]:
    """Events appended, profiles as a snapshot."""
    return [
        Job("events", LINES, D.analytics_events, [], None, "append", fmt="text"),
        Job("profiles", LINES, lambda df: D.analytics_profiles(df, "value"), ["distinct_id"], None, "snapshot", fmt="text"),
    ]


def time_tracking(init, horizon_days: int) -> Job:
    """Time entries up to a near horizon."""
    windows = _line("data array<struct<userId:long,date:string,records:array<struct<taskId:long,spentHours:double>>>>")
    return Job("timetrack", LINES, lambda df: Rc.time_entries(windows(df), init, horizon_days), [], "date", "append", fmt="text")


def human_resources(ddl: str) -> Job:
    """OData entities, dates decoded and full copies dropped."""
    return Job("entities", LINES, lambda df: Rc.odata_entities(_line(ddl)(df)), [], None, "snapshot", fmt="text")


def imaging(studies: DataFrame) -> Job:
    """Instances with the study date of their study."""
    return Job("instances", LINES, lambda df: M.instances(df, studies, raw="value"), ["sop_instance_uid"], "study_date", "append", fmt="text")


def event_frames(refs: DataFrame) -> Job:
    """Elements that event frames refer to (refs: frame_id, element_id)."""
    frames = _line("frame_id string, primary_id string, start_time string, end_time string", "start_time", "end_time")
    return Job("elements", LINES, lambda df: M.event_frame_elements(frames(df), refs), ["frame_id", "element_id"], None, "snapshot", fmt="text")
