"""Document-like families: surveys, mail, chat, sheets, analytics, attribution."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import explode as X
from tidemark.operators import incremental as I
from tidemark.operators import joins as J
from tidemark.operators import reshape as R
from tidemark.operators import scan as Sc
from tidemark.plans import apply as A

# ---- surveys A ------------------------------------------------------------


def survey_responses(df: DataFrame, survey_id: str = "survey_id", raw: str = "raw") -> DataFrame:
    """Responses with their simple fields and a map of answers."""
    fields = R.response_fields(df, raw)
    embedded = F.coalesce(
        F.get_json_object(raw, "$.embeddedData"), F.get_json_object(raw, "$.values.embeddedData.textEntry")
    )
    return fields.withColumns(
        {
            "values": R.question_values(F.get_json_object(raw, "$.values")),
            "labels": F.get_json_object(raw, "$.labels"),
            "displayed_fields": F.get_json_object(raw, "$.displayedFields"),
            "displayed_values": F.get_json_object(raw, "$.displayedValues"),
            "embedded_data": embedded,
        }
    ).drop(raw)


# ---- surveys B ------------------------------------------------------------


def survey_questions(surveys: DataFrame) -> DataFrame:
    """Pages, then their questions; surveys(id, pages[id, questions[..]])."""
    return X.explode_two_level(surveys, "pages", "questions", {"id": "survey_id"}, "id", "page_id")


# ---- mail -----------------------------------------------------------------


def mail_changes(messages: DataFrame, history: DataFrame, since: int) -> DataFrame:
    """Messages added after a history id, and deleted ones as tombstones.

    messages(id, thread_id, history_id, ..); one row per id, the newest wins.
    """
    added = Sc.history_added(history, since)
    fresh = messages.join(added, "id", "left_semi")
    newer = history.where(F.col("id").try_cast("bigint") > since)
    gone = Sc.history_deletes(newer).withColumn(A.DELETED, F.lit(True))
    return fresh.withColumn(A.DELETED, F.lit(False)).unionByName(gone, allowMissingColumns=True)


# ---- chat -----------------------------------------------------------------


def channel_messages(feed: DataFrame, complex_fields: Sequence[str], context: Sequence[str] = ("team_id", "channel_id")) -> DataFrame:
    """A delta feed of messages; nested fields as JSON text, removed ones flagged."""
    rows = Sc.delta_feed(feed, "removed", "id", list(context))
    return R.json_stringify(rows, complex_fields)


def channel_tree(teams: DataFrame, channels: DataFrame, messages: DataFrame) -> DataFrame:
    """Messages with the names of their channel and team."""
    named = J.fan_out(teams.withColumnRenamed("name", "team_name"), channels, "id", "team_id", ["team_name"])
    side = named.select(F.col("id").alias("_c"), F.col("name").alias("channel_name"), "team_name")
    return messages.join(side, F.col("channel_id") == F.col("_c")).drop("_c")


# ---- product analytics ----------------------------------------------------

# Property names known beforehand.
EVENT_PROPERTIES = (
    "time", "distinct_id", "$browser", "$browser_version", "$city", "$current_url", "$device_id", "$initial_referrer",
    "$initial_referring_domain", "$lib_version", "$mp_api_endpoint", "$mp_api_timestamp_ms", "$os", "$region",
    "$screen_height", "$screen_width", "mp_country_code", "mp_lib", "mp_processing_time_ms", "mp_sent_by_lib_version",
)
PROFILE_PROPERTIES = (
    "$first_name", "$last_name", "$email", "$created", "$last_seen", "$name", "$phone", "$city", "$region",
    "$country_code", "$timezone", "$browser", "$os",
)


def bad_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Number of exported lines that are no records and so give no event."""
    parsed = Sc.parse_jsonl(lines, "event string, properties string", value)
    return parsed.agg(F.count_if(F.col(Sc.CORRUPT).isNotNull()).alias("bad_lines"))


def analytics_events(lines: DataFrame, value: str = "value") -> DataFrame:
    """Exported event lines: name, insert id, known properties and the rest as a map.

    Lines that are no records are left out; ``bad_lines`` counts them.
    """
    rows = Sc.parse_jsonl(lines, "event string, properties string", value).where(F.col(Sc.CORRUPT).isNull())
    insert_id = F.try_element_at(F.from_json("properties", "map<string,string>"), F.lit("$insert_id"))
    named = rows.select("event", insert_id.alias("insert_id"), "properties")
    return R.split_properties(named, "properties", EVENT_PROPERTIES)


def analytics_profiles(df: DataFrame, raw: str = "raw") -> DataFrame:
    doc = F.from_json(F.col(raw), "`$distinct_id` string, `$properties` string")
    rows = df.select(doc.alias("d")).select(
        F.col("d.`$distinct_id`").alias("distinct_id"), F.col("d.`$properties`").alias("properties")
    )
    return R.split_properties(rows, "properties", PROFILE_PROPERTIES)


# ---- web analytics --------------------------------------------------------


def report_rows(df: DataFrame, dims: Sequence[str], metrics: dict[str, str], property_id: str, raw: str = "raw") -> DataFrame:
    """Report response rows as named, typed columns under their property."""
    doc = F.from_json(F.col(raw), "rows array<struct<dimensionValues:array<struct<value:string>>,metricValues:array<struct<value:string>>>>")
    rows = df.select(F.explode(doc["rows"]).alias("r")).select(
        F.transform("r.dimensionValues", lambda v: v["value"]).alias("_d"),
        F.transform("r.metricValues", lambda v: v["value"]).alias("_m"),
    )
    return R.with_context(X.reshape_records(rows, dims, metrics, "_d", "_m"), property_id=property_id)


# ---- mobile attribution ---------------------------------------------------


def attribution_batch(report: DataFrame, prev: Any, hours: int, cap: Any, cursor: str = "event_time") -> DataFrame:
    """Report rows from the look-back day up to the frozen bound."""
    typed = report.withColumn(cursor, S.parse_ts_any(F.col(cursor)))
    return I.lookback_days_read(typed, cursor, prev, hours, cap)
