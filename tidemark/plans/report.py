"""Dimension-by-metric reports over a frame of hits.

A hits frame has ``date``, ``user_id``, ``session_id`` and ``event_name``,
optional measures (``revenue``, ``quantity``, ``duration``, ``ad_cost``) and
any dimension columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.filters import report_condition

MAX_DIMENSIONS = 9
MAX_METRICS = 10

# Event names behind the counting metrics.
EVENT_METRICS = {
    "screenPageViews": "page_view",
    "itemsViewed": "view_item",
    "itemsAddedToCart": "add_to_cart",
    "itemsPurchased": "purchase",
    "itemsViewedInPromotion": "view_promotion",
    "itemsClickedInPromotion": "select_promotion",
}
ENGAGED_SECONDS = 10


@dataclass(frozen=True)
class HitModel:
    """How raw columns play the roles of a hits frame."""

    date: Column
    user_id: Column
    session_id: Column
    event_name: Column
    dimensions: dict[str, Column]
    revenue: Column | None = None
    duration: Column | None = None
    ad_cost: Column | None = None
    is_new: Column | None = None
    key_events: tuple[str, ...] = ("purchase",)

    def frame(self, df: DataFrame) -> DataFrame:
        zero = F.lit(0.0)
        return df.select(
            self.date.cast("date").alias("date"),
            self.user_id.alias("user_id"),
            self.session_id.alias("session_id"),
            self.event_name.alias("eventName"),
            (self.revenue if self.revenue is not None else zero).cast("double").alias("_revenue"),
            (self.duration if self.duration is not None else zero).cast("double").alias("_duration"),
            (self.ad_cost if self.ad_cost is not None else zero).cast("double").alias("_ad_cost"),
            (self.is_new if self.is_new is not None else F.lit(False)).alias("_is_new"),
            self.event_name.isin(*self.key_events).alias("_is_key"),
            *[c.alias(n) for n, c in self.dimensions.items() if n not in ("date", "eventName")],
        )


def _count_of(event: str) -> Column:
    return F.count_if(F.col("eventName") == event)


# metric -> (partial sums per dimensions, user and session; final expression)
def _metric(name: str) -> tuple[dict[str, Column], Column]:
    sessions = F.count_distinct("session_id")
    if name in ("activeUsers", "totalUsers"):
        return {}, F.count_distinct("user_id")
    if name == "newUsers":
        return {"_new": F.max("_is_new")}, F.count_distinct(F.when(F.col("_new"), F.col("user_id")))
    if name == "sessions":
        return {}, sessions
    if name == "eventCount":
        return {"_events": F.count("*")}, F.sum("_events")
    if name == "keyEvents":
        return {"_keys": F.count_if(F.col("_is_key"))}, F.sum("_keys")
    if name in ("totalRevenue", "itemRevenue"):
        return {"_rev": F.sum("_revenue")}, F.sum("_rev")
    if name == "advertiserAdCost":
        return {"_cost": F.sum("_ad_cost")}, F.sum("_cost")
    if name in EVENT_METRICS:
        return {f"_n_{name}": _count_of(EVENT_METRICS[name])}, F.sum(f"_n_{name}")
    engaged = {"_secs": F.sum("_duration"), "_hits": F.count("*"), "_keyed": F.max("_is_key")}
    is_engaged = (F.col("_secs") >= ENGAGED_SECONDS) | (F.col("_hits") >= 2) | F.col("_keyed")
    engaged_sessions = F.count_distinct(F.when(is_engaged, F.col("session_id")))
    if name == "engagedSessions":
        return engaged, engaged_sessions
    if name == "engagementRate":
        return engaged, engaged_sessions / sessions
    if name == "bounceRate":
        return engaged, 1 - engaged_sessions / sessions
    if name == "averageSessionDuration":
        return engaged, F.sum("_secs") / sessions
    raise ValueError(f"unknown metric {name!r}")


def relative_day(text: str, today: date) -> date:
    """``today``, ``yesterday``, ``NdaysAgo`` or an ISO date."""
    if text == "today":
        return today
    if text == "yesterday":
        return today - timedelta(days=1)
    if text.endswith("daysAgo"):
        return today - timedelta(days=int(text[: -len("daysAgo")]))
    return date.fromisoformat(text)


def relative_range(start: str, cap: date, lookback_days: int, last_date: date | None = None) -> tuple[date, date]:
    """First run: the configured start; later: ``lookback_days`` before the last date seen."""
    if last_date is not None:
        return last_date - timedelta(days=lookback_days), cap
    return relative_day(start, cap), cap


def report(
    hits: DataFrame,
    model: HitModel,
    dimensions: Sequence[str],
    metrics: Sequence[str],
    start: Any = None,
    end: Any = None,
    dimension_filter: Any = None,
    metric_filter: Any = None,
    order: Sequence[str] | None = None,
    property_id: str | None = None,
) -> DataFrame:
    """One row per combination of dimensions.

    Hits are first summed per dimensions, user and session.  Distinct counts
    then run over that much smaller frame.
    """
    if not metrics or len(metrics) > MAX_METRICS:
        raise ValueError(f"a report has 1 to {MAX_METRICS} metrics")
    if len(dimensions) > MAX_DIMENSIONS:
        raise ValueError(f"a report has at most {MAX_DIMENSIONS} dimensions")
    frame = model.frame(hits)
    missing = [d for d in dimensions if d not in frame.columns]
    if missing:
        raise ValueError(f"unknown dimensions {missing}")
    if start is not None:
        frame = frame.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        frame = frame.where(F.col("date") <= F.lit(end).cast("date"))
    if dimension_filter is not None:
        names = {d: F.col(d) for d in frame.columns if not d.startswith("_")}
        frame = frame.where(report_condition(dimension_filter, names))
    partial: dict[str, Column] = {}
    final: list[Column] = []
    for m in metrics:
        sums, result = _metric(m)
        partial.update(sums)
        final.append(result.alias(m))
    level = [*dimensions, "user_id", "session_id"]
    parts = [c.alias(n) for n, c in partial.items()] or [F.count("*").alias("_n")]
    small = frame.groupBy(*level).agg(*parts)
    out = small.groupBy(*dimensions).agg(*final)
    if metric_filter is not None:
        out = out.where(report_condition(metric_filter, {m: F.col(m) for m in metrics}))
    if property_id is not None:
        out = out.select(F.lit(property_id).alias("property_id"), "*")
    return out.orderBy(*order) if order else out


def report_multi(frames: dict[str, DataFrame], model: HitModel, **spec: Any) -> DataFrame:
    """The same report over several properties, with the overall newest date."""
    parts = [report(df, model, property_id=p, **spec) for p, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def report_table_meta(dimensions: Sequence[str]) -> dict[str, Any]:
    """Keys and ingestion type of a report table."""
    dated = "date" in dimensions
    return {
        "primary_keys": ["property_id", *dimensions],
        "cursor_field": "date" if dated else None,
        "ingestion_type": "cdc" if dated else "snapshot",
    }


# The named reports, as (dimensions, metrics).
NAMED_REPORTS = {
    "traffic_by_country": (["date", "country"], ["activeUsers", "sessions", "screenPageViews"]),
    "user_acquisition": (
        ["date", "sessionSource", "sessionMedium"],
        ["sessions", "activeUsers", "newUsers", "engagementRate"],
    ),
    "events_summary": (["date", "eventName"], ["eventCount", "activeUsers"]),
    "page_performance": (
        ["date", "pagePath", "pageTitle"],
        ["screenPageViews", "averageSessionDuration", "bounceRate"],
    ),
    "device_breakdown": (["date", "deviceCategory", "browser"], ["activeUsers", "sessions", "engagementRate"]),
    "landing_page_performance": (
        ["date", "landingPage"],
        ["sessions", "activeUsers", "newUsers", "keyEvents", "totalRevenue"],
    ),
    "ecommerce_purchases": (
        ["date", "itemName", "itemId"],
        ["itemsViewed", "itemsAddedToCart", "itemsPurchased", "itemRevenue"],
    ),
    "purchase_journey": (["date", "eventName"], ["activeUsers", "eventCount"]),
    "checkout_journey": (["date", "eventName"], ["activeUsers", "eventCount"]),
    "promotions_performance": (
        ["date", "itemPromotionName"],
        ["itemsViewedInPromotion", "itemsClickedInPromotion", "itemRevenue"],
    ),
    "user_retention": (["date", "newVsReturning"], ["activeUsers", "sessions", "engagementRate"]),
    "demographic_details": (["date", "language", "country"], ["activeUsers", "newUsers", "engagedSessions"]),
    "audience_performance": (["date", "audienceName"], ["activeUsers", "sessions", "keyEvents"]),
    "tech_details": (["date", "browser", "operatingSystem"], ["activeUsers", "sessions", "engagementRate"]),
    "advertising_channels": (["date", "defaultChannelGroup"], ["keyEvents", "advertiserAdCost", "totalRevenue"]),
}
REPORT_START = "30daysAgo"
REPORT_LOOKBACK_DAYS = 3


def prebuilt_report(
    hits: DataFrame, model: HitModel, name: str, today: date, last_date: date | None = None, **overrides: Any
) -> DataFrame:
    """A named report over its default range; the caller's arguments win."""
    if name not in NAMED_REPORTS:
        raise ValueError(f"unknown report {name!r}")
    dims, metrics = NAMED_REPORTS[name]
    start, end = relative_range(
        overrides.pop("start_date", REPORT_START), today, overrides.pop("lookback_days", REPORT_LOOKBACK_DAYS), last_date
    )
    spec = {"dimensions": dims, "metrics": metrics, "start": start, "end": end, **overrides}
    return report(hits, model, **spec)
