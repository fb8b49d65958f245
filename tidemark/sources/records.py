"""Business record families: example tables, code hosting, commerce, CRM, support, HR, time tracking, ontology."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import scalars as S
from tidemark.operators import explode as X
from tidemark.operators import incremental as I
from tidemark.operators import joins as J
from tidemark.operators import reshape as R
from tidemark.operators import scan as Sc
from tidemark.operators import setops as U
from tidemark.operators.aggregate import dedupe_rows
from tidemark.operators.paging import cap_records
from tidemark.sources.base import Job


# The five example tables, every ingestion type once.
EXAMPLE = {
    "products": ("product_id string, name string, price double, category string", ["product_id"], None, "snapshot"),
    "events": (
        "event_id string, event_type string, user_id string, payload string, created_at timestamp", [], "created_at", "append",
    ),
    "users": (
        "user_id string, email string, display_name string, status string, updated_at timestamp", ["user_id"], "updated_at", "cdc",
    ),
    "orders": (
        "order_id string, user_id string, amount double, status string, updated_at timestamp", ["order_id"], "updated_at", "cdc_with_deletes",
    ),
    "metrics": (
        "metric_id string, name string, value struct<count:bigint,label:string,measure:double>, host string, updated_at timestamp",
        ["metric_id"], "updated_at", "cdc",
    ),
}


def example_jobs() -> list[Job]:
    return [Job(name, ddl, lambda df: df, keys, cursor, kind) for name, (ddl, keys, cursor, kind) in EXAMPLE.items()]


# ---- code hosting A -------------------------------------------------------

# Columns of a commit, their path in a record and how it is read.
COMMIT_FIELDS = {
    "sha": ("sha", "text"),
    "node_id": ("node_id", "text"),
    "commit_message": ("commit.message", "text"),
    "commit_author_name": ("commit.author.name", "text"),
    "commit_author_email": ("commit.author.email", "text"),
    "commit_author_date": ("commit.author.date", "text"),
    "commit_committer_name": ("commit.committer.name", "text"),
    "commit_committer_email": ("commit.committer.email", "text"),
    "commit_committer_date": ("commit.committer.date", "text"),
    "html_url": ("html_url", "text"),
    "url": ("url", "text"),
    "author": ("author", "json"),
    "committer": ("committer", "json"),
}


def commits(df: DataFrame, owner: str, repo: str, raw: str = "raw") -> DataFrame:
    """Commit records flattened, with the repository stamped on."""
    flat = R.flatten_envelope(df, raw, COMMIT_FIELDS)
    times = {c: S.parse_ts_any(F.col(c)) for c in ("commit_author_date", "commit_committer_date")}
    return R.with_context(flat.withColumns(times), repository_owner=owner, repository_name=repo)


def pull_reviews(pulls: DataFrame, reviews: DataFrame) -> DataFrame:
    """Reviews under their pull request (pulls: number, repository; reviews: pull_number)."""
    return J.fan_out(pulls, reviews, "number", "pull_number", ["repository"])


# ---- code hosting B -------------------------------------------------------

def repository_changes(changes: DataFrame, marks: DataFrame, key: str, cursor: str) -> DataFrame:
    """Rows newer than the mark of their own repository."""
    return J.per_key_since(changes, marks, key, cursor)


def work_item_revisions(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Revisions keyed by (id, rev) with the common fields lifted."""
    fields = {
        "id": ("id", "long"), "rev": ("rev", "long"), "title": ("fields.Title", "text"), "state": ("fields.State", "text"),
        "changed_date": ("fields.ChangedDate", "text"), "fields_json": ("fields", "json"),
    }
    flat = R.flatten_envelope(df, raw, fields)
    return flat.withColumn("changed_date", S.parse_ts_any(F.col("changed_date")))


# ---- commerce -------------------------------------------------------------

def order_children(orders: DataFrame, children: DataFrame, since: Any, init: Any) -> DataFrame:
    """Children of orders updated in ``(since, init]``; orders(id, updated_at), children(order_id, ..)."""
    changed = I.cap_at_start(orders, "updated_at", init)
    return J.changed_parent_children(changed, children, "id", "order_id", "updated_at", since)


# ---- CRM A ----------------------------------------------------------------

def crm_objects(df: DataFrame, properties: Sequence[str], associations: Sequence[str], raw: str = "raw") -> DataFrame:
    """Objects with a struct of properties (blank text as null) and id lists per association."""
    doc = F.from_json(
        F.col(raw), "id string, createdAt string, updatedAt string, archived boolean, archivedAt string, "
        "properties map<string,string>, associations map<string,string>",
    )
    open_doc = df.select(doc.alias("_d")).select("_d.*")
    cleaned = F.transform_values("properties", lambda k, v: F.nullif(v, F.lit("")))
    rows = open_doc.withColumn("_p", cleaned)
    props = F.struct(*[F.try_element_at("_p", F.lit(p)).alias(p) for p in properties])
    times = {c: S.parse_ts_any(F.col(c)) for c in ("createdAt", "updatedAt", "archivedAt")}

    def ids(name: str) -> Column:
        body = F.try_element_at("associations", F.lit(name))
        listed = F.when(F.trim(body).startswith("{"), F.get_json_object(body, "$.results")).otherwise(body)
        items = F.from_json(listed, "array<string>")
        return F.coalesce(
            F.transform(items, lambda x: F.when(F.trim(x).startswith("{"), F.coalesce(F.get_json_object(x, "$.id"), F.lit(""))).otherwise(x)),
            F.array().cast("array<string>"),
        )

    linked = [ids(a).alias(a) for a in associations]
    return rows.withColumns(times).select(
        "id", "createdAt", "updatedAt", "archived", "archivedAt", props.alias("properties"), *linked
    )


def crm_deletes(objects: DataFrame, since: Any = None) -> DataFrame:
    """Archived objects as tombstones."""
    return Sc.scan_archived_as_deletes(objects, "updatedAt", since=since).select("id", "updatedAt")


# ---- CRM B ----------------------------------------------------------------

def subform_lines(parents: DataFrame, field: str) -> DataFrame:
    """Line rows of a subform with the parent id."""
    return X.explode_children(parents, field, {"id": "parent_id"})


def module_changes(rows: DataFrame, deletes: DataFrame) -> DataFrame:
    """Changed records, then deleted ids flagged."""
    return U.union_changes(rows, deletes)


# ---- support desk ---------------------------------------------------------

def ticket_comments(events: DataFrame) -> DataFrame:
    """Comments out of ticket events: only child entries of that kind."""
    return X.explode_filtered(events, "child_events", lambda c: c["event_type"] == "Comment", ["ticket_id", "created_at"])


# ---- HR -------------------------------------------------------------------

def odata_entities(df: DataFrame) -> DataFrame:
    """Entities without protocol fields, dates decoded, full duplicates dropped."""
    clean = R.drop_metadata_keys(df)
    dates = {f.name: S.odata_date(F.col(f.name)) for f in clean.schema if isinstance(f.dataType, T.StringType)}
    return dedupe_rows(clean.withColumns(dates) if dates else clean)


# ---- time tracking --------------------------------------------------------

def time_entries(df: DataFrame, init: Any, horizon_days: int) -> DataFrame:
    """``{data: [{userId, date, records}]}`` windows as one row per record, near future allowed."""
    rows = X.explode_envelope_dates(df, "data", "records", {"userId": "user_id", "date": "date"})
    dated = R.snake_case_columns(rows).withColumn("date", F.col("date").try_cast("date"))
    return I.forward_horizon(dated, "date", init, horizon_days)


# ---- ontology objects -----------------------------------------------------

def object_batch(df: DataFrame, cursor: str, key: str, size: int, last: Any = None, last_key: Any = None):
    """The next objects after a position, and the position to resume from."""
    return cap_records(df, cursor, key, size, last, last_key)
