"""Queries over time series and reports."""

from __future__ import annotations

from functools import reduce
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import pyramid as Py
from tidemark.operators import timeseries as Ts
from tidemark.operators import user_days as Ud
from tidemark.plans import report as Rp
from tidemark.registry.base import ORACLES, generation, query

START, END = datetime(2024, 1, 3), datetime(2024, 1, 28)
_IN = "ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-28'"
_ARGS = ("event_type", "ts", "value", START, END)


def rounded(df, digits=4):
    return df.withColumn("value", F.round("value", digits))


_SUMMARY = """
  SELECT tag, timestamp, round(sum(value), 4) AS "Total", round(avg(value), 4) AS "Average", round(min(value), 4) AS "Minimum",
    round(max(value), 4) AS "Maximum", round(max(value) - min(value), 4) AS "Range", round(stddev_samp(value), 4) AS "StdDev",
    CAST(count(value) AS DOUBLE) AS "Count" FROM p GROUP BY tag, timestamp
"""
_LONG = 'UNPIVOT INCLUDE NULLS (value FOR summary_type IN ("Total", "Average", "Minimum", "Maximum", "Range", "StdDev", "Count"))'


@query(
    "ts_summary",
    f"WITH p AS (SELECT event_type AS tag, TIMESTAMP '2024-01-03' AS timestamp, value FROM events WHERE {_IN}) "
    f"SELECT * FROM ({_SUMMARY}) {_LONG}",
)
def ts_summary(t):
    return rounded(Ts.ts_summary(t.events, *_ARGS))


@query(
    "ts_summary_daily",
    f"WITH p AS (SELECT event_type AS tag, date_trunc('day', ts) AS timestamp, value FROM events WHERE {_IN} AND value <= 80) "
    f"SELECT * FROM ({_SUMMARY}) {_LONG}",
)
def ts_summary_daily(t):
    """Per day; values above 80 count as bad points."""
    ev = t.events.withColumn("good", F.when(F.col("value") > 80, F.lit(False)))
    return rounded(Ts.ts_summary(ev, *_ARGS, duration_seconds=86400, good="good"))


_SEGMENTS = """
  one AS (SELECT event_type AS tag, epoch_us(ts) AS t, max(value) AS v FROM events WHERE ts < TIMESTAMP '2024-01-28' GROUP BY 1, 2),
  nxt AS (SELECT tag, t, v, lead(t) OVER (PARTITION BY tag ORDER BY t) AS u FROM one),
  seg AS (SELECT tag, greatest(t, epoch_us(TIMESTAMP '2024-01-03')) AS t, least(coalesce(u, epoch_us(TIMESTAMP '2024-01-28')), epoch_us(TIMESTAMP '2024-01-28')) AS u, v FROM nxt),
  ok AS (SELECT * FROM seg WHERE t < u)
"""


@query(
    "ts_time_weighted",
    f"""
    WITH {_SEGMENTS},
    b AS (SELECT tag, v, t, u, unnest(generate_series((t - epoch_us(TIMESTAMP '2024-01-03')) // 86400000000, (u - 1 - epoch_us(TIMESTAMP '2024-01-03')) // 86400000000)) AS n FROM ok),
    d AS (SELECT tag, n, v, CAST(least(u, epoch_us(TIMESTAMP '2024-01-03') + (n + 1) * 86400000000) - greatest(t, epoch_us(TIMESTAMP '2024-01-03') + n * 86400000000) AS DOUBLE) AS dt FROM b),
    g AS (SELECT tag, n, sum(dt) AS w, sum(v * dt) AS wv, min(v) AS mn, max(v) AS mx, CAST(count(*) AS DOUBLE) AS c FROM d GROUP BY 1, 2)
    SELECT tag, TIMESTAMP '2024-01-03' + to_days(CAST(n AS INTEGER)) AS timestamp, 'Average' AS summary_type, round(wv / w, 4) AS value FROM g
    UNION ALL SELECT tag, TIMESTAMP '2024-01-03' + to_days(CAST(n AS INTEGER)), 'Total', round(wv / 86400000000.0, 4) FROM g
    UNION ALL SELECT tag, TIMESTAMP '2024-01-03' + to_days(CAST(n AS INTEGER)), 'Minimum', mn FROM g
    UNION ALL SELECT tag, TIMESTAMP '2024-01-03' + to_days(CAST(n AS INTEGER)), 'Range', round(mx - mn, 4) FROM g
    UNION ALL SELECT tag, TIMESTAMP '2024-01-03' + to_days(CAST(n AS INTEGER)), 'Count', c FROM g
    """,
)
def ts_time_weighted(t):
    types = ["Average", "Total", "Minimum", "Range", "Count"]
    return rounded(Ts.ts_summary_time_weighted(t.events, *_ARGS, duration_seconds=86400, types=types))


@query(
    "ts_time_weighted_range",
    f"""
    WITH {_SEGMENTS}, g AS (SELECT tag, sum(CAST(u - t AS DOUBLE)) AS w, sum(v * (u - t)) AS wv FROM ok GROUP BY 1),
    s AS (SELECT ok.tag, sqrt(sum((v - wv / w) * (v - wv / w) * (u - t)) / any_value(w)) AS sd FROM ok JOIN g USING (tag) GROUP BY 1)
    SELECT tag, TIMESTAMP '2024-01-03' AS timestamp, 'Average' AS summary_type, round(wv / w, 4) AS value FROM g
    UNION ALL SELECT tag, TIMESTAMP '2024-01-03', 'StdDev', round(sd, 4) FROM s
    """,
)
def ts_time_weighted_range(t):
    return rounded(Ts.ts_summary_time_weighted(t.events, *_ARGS, types=["Average", "StdDev"]))


@query(
    "ts_calculated",
    f"""
    SELECT event_type AS tag, TIMESTAMP '2024-01-03' + to_hours(CAST(6 * ((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-03')) // 21600000000) AS INTEGER)) AS timestamp,
           round(avg(value), 9) AS value FROM events WHERE {_IN} GROUP BY 1, 2
    """,
)
def ts_calculated(t):
    return rounded(Ts.ts_calculated(t.events, *_ARGS, 6 * 3600, "average"), 9)


@query(
    "ts_plot",
    f"""
    WITH p AS (SELECT event_type AS tag, ts, value, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-03')) * 50 // (25 * 86400000000) AS b FROM events WHERE {_IN}),
    r AS (SELECT *, row_number() OVER (PARTITION BY tag, b ORDER BY ts) AS f, row_number() OVER (PARTITION BY tag, b ORDER BY ts DESC) AS l,
                 row_number() OVER (PARTITION BY tag, b ORDER BY value, ts) AS mn, row_number() OVER (PARTITION BY tag, b ORDER BY value DESC, ts) AS mx FROM p)
    SELECT tag, ts AS timestamp, value FROM r WHERE f = 1 OR l = 1 OR mn = 1 OR mx = 1
    """,
)
def ts_plot(t):
    return Ts.ts_plot(t.events, *_ARGS, 50)


@query(
    "ts_interpolate",
    """
    WITH p AS (SELECT event_type AS tag, epoch_us(ts) AS t, max(value) AS v FROM events GROUP BY 1, 2),
    n AS (SELECT tag, t, v, lead(t) OVER w AS t2, lead(v) OVER w AS v2 FROM p WINDOW w AS (PARTITION BY tag ORDER BY t)),
    g AS (SELECT tag, x FROM (SELECT DISTINCT tag FROM p),
          (SELECT epoch_us(unnest(generate_series(TIMESTAMP '2023-12-31', TIMESTAMP '2024-02-01', INTERVAL 1 HOUR))) AS x)),
    j AS (SELECT g.tag, g.x, n.t, n.v, n.t2, n.v2 FROM g ASOF LEFT JOIN n ON g.tag = n.tag AND g.x >= n.t)
    SELECT tag, make_timestamp(x) AS timestamp,
           round(CASE WHEN t = x THEN v WHEN t2 IS NULL THEN NULL ELSE v + (v2 - v) * CAST(x - t AS DOUBLE) / (t2 - t) END, 4) AS value FROM j
    """,
)
def ts_interpolate(t):
    return rounded(
        Ts.ts_interpolate(t.events, "event_type", "ts", "value", datetime(2023, 12, 31), datetime(2024, 2, 1), 3600)
    )


@query(
    "end_value",
    "SELECT event_type, ts, value FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) = 1",
)
def end_value(t):
    return Ts.end_value(t.events.select("event_type", "ts", "value"), "event_type", "ts")


@query(
    "current_value",
    """
    SELECT user_id, ts, value FROM events WHERE ts <= TIMESTAMP '2024-01-20'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1
    """,
)
def current_value(t):
    return Ts.current_value(t.events.select("user_id", "ts", "value"), "user_id", "ts", datetime(2024, 1, 20))


@query(
    "value_at_time",
    """
    SELECT event_type, ts, value FROM events WHERE ts <= TIMESTAMP '2024-01-14 09:30:00'
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) = 1
    """,
)
def value_at_time(t):
    return Ts.value_at_time(t.events.select("event_type", "ts", "value"), "event_type", "ts", datetime(2024, 1, 14, 9, 30))


@query("value_at_exact_time", "SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey FROM orders WHERE o_orderdate = TIMESTAMP '1998-06-01' GROUP BY 1, 2")
def value_at_exact_time(t):
    """Exact form, on customers with orders on the day."""
    single = t.orders.groupBy("o_custkey", "o_orderdate").agg(F.max("o_orderkey").alias("o_orderkey"))
    return Ts.value_at_time(single, "o_custkey", "o_orderdate", datetime(1998, 6, 1), exact=True)


@query(
    "values_at",
    """
    WITH q AS (SELECT DISTINCT event_type, date_trunc('hour', ts) AS ts FROM events)
    SELECT q.event_type, q.ts, e.value FROM q ASOF LEFT JOIN events e ON q.event_type = e.event_type AND q.ts >= e.ts
    """,
)
def values_at(t):
    """Value of each tag at the start of every hour in which it has an event."""
    probes = t.events.select("event_type", F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("ts")).distinct()
    return Ts.values_at(probes, t.events, "event_type", "ts", "value")



def model():
    """Events as hits: a session is a user's day."""
    return Rp.HitModel(
        date=F.col("ts"),
        user_id=F.col("user_id"),
        session_id=F.concat_ws("-", F.col("user_id"), F.to_date("ts")),
        event_name=F.col("event_type"),
        dimensions={
            "country": F.col("country"),
            "newVsReturning": F.when(F.to_date("ts") <= F.lit("2024-01-05").cast("date"), "new").otherwise("returning"),
        },
        revenue=F.when(F.col("event_type") == "purchase", F.col("value")),
        duration=F.col("value") / 10,
        is_new=F.to_date("ts") <= F.lit("2024-01-05").cast("date"),
    )


_H = """
  h AS (SELECT CAST(ts AS DATE) AS date, user_id, user_id || '-' || strftime(ts, '%Y-%m-%d') AS session_id, event_type AS name,
          coalesce(n_name, 'none') AS country, CASE WHEN CAST(ts AS DATE) <= DATE '2024-01-05' THEN 'new' ELSE 'returning' END AS nvr,
          CASE WHEN event_type = 'purchase' THEN value END AS revenue, value / 10 AS duration
        FROM events LEFT JOIN customer ON user_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey)
"""


def hits(t):
    """Events with the country of the user."""
    home = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("_c"), F.col("n_name").alias("_n")
    )
    out = t.events.join(home, F.col("user_id") == F.col("_c"), "left")
    return out.withColumn("country", F.coalesce("_n", F.lit("none"))).drop("_c", "_n")


TODAY = date(2024, 1, 30)


@query(
    "report_daily",
    f"""
    WITH {_H} SELECT '123' AS property_id, date, country, count(DISTINCT user_id) AS "activeUsers", count(DISTINCT session_id) AS sessions,
      CAST(count(*) AS BIGINT) AS "eventCount", round(sum(revenue), 2) AS "totalRevenue"
    FROM h WHERE name <> 'error' AND date >= DATE '2024-01-05' AND date <= DATE '2024-01-25' GROUP BY 1, 2, 3 HAVING count(*) > 2
    """,
)
def report_daily(t):
    out = Rp.report(
        hits(t),
        model(),
        ["date", "country"],
        ["activeUsers", "sessions", "eventCount", "totalRevenue"],
        "2024-01-05",
        "2024-01-25",
        dimension_filter={"notExpression": {"filter": {"fieldName": "eventName", "stringFilter": {"value": "error"}}}},
        metric_filter={
            "filter": {"fieldName": "eventCount", "numericFilter": {"operation": "GREATER_THAN", "value": {"int64Value": "2"}}}
        },
        property_id="123",
    )
    return out.withColumn("totalRevenue", F.round(F.when(F.col("totalRevenue") != 0, F.col("totalRevenue")), 2))


@query(
    "report_rates",
    f"""
    WITH {_H}, s AS (SELECT country, user_id, session_id, sum(duration) AS secs, count(*) AS n, max(CASE WHEN name = 'purchase' THEN 1 ELSE 0 END) AS k,
      max(CASE WHEN nvr = 'new' THEN 1 ELSE 0 END) AS fresh FROM h GROUP BY 1, 2, 3)
    SELECT country, count(DISTINCT CASE WHEN fresh = 1 THEN user_id END) AS "newUsers",
      count(*) FILTER (secs >= 10 OR n >= 2 OR k = 1) AS "engagedSessions",
      round(count(*) FILTER (secs >= 10 OR n >= 2 OR k = 1) / count(*), 6) AS "engagementRate",
      round(1 - count(*) FILTER (secs >= 10 OR n >= 2 OR k = 1) / count(*), 6) AS "bounceRate",
      round(sum(secs) / count(*), 4) AS "averageSessionDuration" FROM s GROUP BY 1
    """,
)
def report_rates(t):
    metrics = ["newUsers", "engagedSessions", "engagementRate", "bounceRate", "averageSessionDuration"]
    out = Rp.report(hits(t), model(), ["country"], metrics)
    return out.withColumns(
        {
            "engagementRate": F.round("engagementRate", 6),
            "bounceRate": F.round("bounceRate", 6),
            "averageSessionDuration": F.round("averageSessionDuration", 4),
        }
    )


@query(
    "prebuilt_events_summary",
    f"""WITH {_H} SELECT date, name AS "eventName", CAST(count(*) AS BIGINT) AS "eventCount", count(DISTINCT user_id) AS "activeUsers"
    FROM h WHERE date >= DATE '2023-12-31' AND date <= DATE '2024-01-30' GROUP BY 1, 2""",
)
def prebuilt_events_summary(t):
    return Rp.prebuilt_report(hits(t), model(), "events_summary", TODAY)


@query(
    "prebuilt_user_retention",
    f"""WITH {_H}, s AS (SELECT date, nvr, user_id, session_id, sum(duration) AS secs, count(*) AS n, max(CASE WHEN name = 'purchase' THEN 1 ELSE 0 END) AS k FROM h
      WHERE date >= DATE '2024-01-17' AND date <= DATE '2024-01-30' GROUP BY 1, 2, 3, 4)
    SELECT date, nvr AS "newVsReturning", count(DISTINCT user_id) AS "activeUsers", count(DISTINCT session_id) AS sessions,
      round(count(*) FILTER (secs >= 10 OR n >= 2 OR k = 1) / count(*), 6) AS "engagementRate" FROM s GROUP BY 1, 2""",
)
def prebuilt_user_retention(t):
    """A later run: three days before the last date seen."""
    out = Rp.prebuilt_report(hits(t), model(), "user_retention", TODAY, last_date=date(2024, 1, 20))
    return out.withColumn("engagementRate", F.round("engagementRate", 6))




@query(
    "prebuilt_traffic_by_country",
    f"""WITH {_H} SELECT date, country, count(DISTINCT user_id) AS "activeUsers", count(DISTINCT session_id) AS sessions,
      CAST(count(*) FILTER (name = 'page_view') AS BIGINT) AS "screenPageViews" FROM h
    WHERE date >= DATE '2024-01-15' AND date <= DATE '2024-01-30' GROUP BY 1, 2""",
)
def prebuilt_traffic_by_country(t):
    return Rp.prebuilt_report(hits(t), model(), "traffic_by_country", TODAY, start_date="15daysAgo")


@query(
    "report_multi",
    f"""WITH {_H} SELECT CASE WHEN country = 'none' THEN 'p2' ELSE 'p1' END AS property_id, date, count(DISTINCT session_id) AS sessions,
      count(DISTINCT user_id) AS "activeUsers" FROM h GROUP BY 1, 2""",
)
def report_multi(t):
    everything = hits(t)
    frames = {"p1": everything.where("country <> 'none'"), "p2": everything.where("country = 'none'")}
    return Rp.report_multi(frames, model(), dimensions=["date"], metrics=["sessions", "activeUsers"])


_NAMES = ["page_view", "view_item", "add_to_cart", "purchase", "view_promotion", "select_promotion", "click", "error"]
# a value for every dimension the named reports use: a prefix and the number of values
_DIMENSIONS = {
    "country": ("c", 5), "sessionSource": ("s", 3), "sessionMedium": ("m", 2), "pagePath": ("p", 6), "pageTitle": ("t", 4),
    "deviceCategory": ("d", 3), "browser": ("b", 4), "landingPage": ("l", 5), "itemName": ("n", 6), "itemId": ("i", 6),
    "itemPromotionName": ("o", 3), "newVsReturning": ("r", 2), "language": ("g", 4), "audienceName": ("a", 3),
    "operatingSystem": ("y", 3), "defaultChannelGroup": ("h", 4),
}


def _all_reports_sql() -> str:
    """Every named report in long form, each from its session rows."""
    name = "CASE " + " ".join(f"WHEN event_id % 8 = {i} THEN '{n}'" for i, n in enumerate(_NAMES)) + " END"
    dims = ", ".join(f"""'{p}' || ((user_id + event_id // 8) % {k}) AS "{d}" """ for d, (p, k) in _DIMENSIONS.items())
    engaged = "count(*) FILTER (secs >= 10 OR n >= 2 OR keys > 0)"
    value = {
        "activeUsers": "count(DISTINCT user_id)", "sessions": "count(*)", "newUsers": "count(DISTINCT CASE WHEN fresh THEN user_id END)",
        "eventCount": "sum(n)", "keyEvents": "sum(keys)", "totalRevenue": "sum(rev)", "itemRevenue": "sum(rev)",
        "advertiserAdCost": "sum(cost)", "engagedSessions": engaged, "engagementRate": f"{engaged} / count(*)",
        "bounceRate": f"1 - {engaged} / count(*)", "averageSessionDuration": "sum(secs) / count(*)",
        "screenPageViews": "sum(e0)", "itemsViewed": "sum(e1)", "itemsAddedToCart": "sum(e2)", "itemsPurchased": "sum(e3)",
        "itemsViewedInPromotion": "sum(e4)", "itemsClickedInPromotion": "sum(e5)",
    }
    parts = []
    for report, (by, metrics) in Rp.NAMED_REPORTS.items():
        keys = ", ".join(f'"{d}"' for d in by)
        key = " || '|' || ".join(f'"{d}"::VARCHAR' for d in by)
        session = f"""SELECT {keys}, user_id, session_id, sum(duration) AS secs, count(*) AS n, count(*) FILTER (name = 'purchase') AS keys,
            bool_or(fresh) AS fresh, sum(revenue) AS rev, sum(cost) AS cost, {', '.join(f"count(*) FILTER (name = '{n}') AS e{i}" for i, n in enumerate(_NAMES))}
            FROM h GROUP BY {keys}, user_id, session_id"""
        for m in metrics:
            parts.append(f"SELECT '{report}' AS report, {key} AS key, '{m}' AS metric, round(({value[m]})::DOUBLE, 4) AS value FROM ({session}) GROUP BY {keys}")
    return f"""
    WITH h AS (SELECT CAST(ts AS DATE) AS date, user_id, user_id || '-' || strftime(ts, '%Y-%m-%d') AS session_id, {name} AS name, {name} AS "eventName",
        {dims}, CASE WHEN event_id % 8 = 3 THEN value ELSE 0 END AS revenue, value / 7 AS duration, value / 11 AS cost,
        CAST(ts AS DATE) <= DATE '2024-01-05' AS fresh FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2023-12-31' AND DATE '2024-01-30')
    {' UNION ALL '.join(parts)}"""


@query("prebuilt_reports_all", _all_reports_sql())
def prebuilt_reports_all(t):
    """All named reports over their default range, one row per report, key and metric."""
    name = F.get(F.array(*[F.lit(n) for n in _NAMES]), (F.col("event_id") % 8).cast("int"))
    spot = F.col("user_id") + F.expr("event_id div 8")
    wide = Rp.HitModel(
        date=F.col("ts"), user_id=F.col("user_id"), session_id=F.concat_ws("-", F.col("user_id"), F.to_date("ts")), event_name=name,
        dimensions={d: F.concat(F.lit(p), (spot % k).cast("string")) for d, (p, k) in _DIMENSIONS.items()},
        revenue=F.when(F.col("event_id") % 8 == 3, F.col("value")).otherwise(0), duration=F.col("value") / 7,
        ad_cost=F.col("value") / 11, is_new=F.to_date("ts") <= F.lit("2024-01-05").cast("date"),
    )
    parts = []
    for report, (dims, metrics) in Rp.NAMED_REPORTS.items():
        out = Rp.prebuilt_report(t.events, wide, report, TODAY)
        key = F.concat_ws("|", *[F.col(d).cast("string") for d in dims]).alias("key")
        rows = out.select(key, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(["key"], metrics, "metric", "value")
        parts.append(rows.select(F.lit(report).alias("report"), "key", "metric", F.round("value", 4).alias("value")))
    return reduce(DataFrame.unionByName, parts)


def kept_users(t, dims=()):
    """Bitmaps of three quarters of the events, then of the rest, most of which are late; new users get numbers on the way."""
    first, later = t.events.where("event_id % 4 <> 0"), t.events.where("event_id % 4 = 0")
    users = generation(Ud.number_users(first, "user_id"))
    kept = generation(Ud.day_bitmaps(first, users, "user_id", "ts", dims))
    users = generation(Ud.number_users(later, "user_id", users))
    return Ud.add_days(kept, Ud.day_bitmaps(later, users, "user_id", "ts", dims))


@query(
    "users_rolling",
    """
    WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE user_id IS NOT NULL)
    SELECT day, count(DISTINCT user_id) AS users FROM d JOIN events ON CAST(ts AS DATE) BETWEEN day - 6 AND day GROUP BY day
    """,
)
def users_rolling(t):
    """Exact users of the last seven days, every day, from kept bitmaps."""
    return Ud.rolling_users(kept_users(t), 7)


@query(
    "users_between",
    """
    SELECT event_type, count(DISTINCT user_id) AS users FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-21' GROUP BY event_type
    """,
)
def users_between(t):
    """Exact users of a range of days per event type."""
    return Ud.users_between(kept_users(t, ["event_type"]), "2024-01-05", "2024-01-21", ["event_type"])


def updated_pyramid(t):
    """Nodes of two thirds of the events, then updated by the rest, which lies all over them."""
    first, late = t.events.where("event_id % 3 <> 0"), t.events.where("event_id % 3 = 0")
    nodes = generation(Py.build_pyramid(first, "event_type", "ts", "value", 3600))
    return Py.update_pyramid(nodes, t.events, late, "event_type", "ts", "value", 3600)


@query("ts_pyramid_weighted", ORACLES["ts_time_weighted_range"])
def ts_pyramid_weighted(t):
    """Time-weighted average and deviation of a range from a few nodes."""
    return rounded(Py.range_summary(updated_pyramid(t), t.events, *_ARGS, 3600, types=["Average", "StdDev"]))


@query(
    "ts_pyramid",
    f"WITH p AS (SELECT event_type AS tag, TIMESTAMP '2024-01-03 05:06:07' AS timestamp, value FROM events "
    f"WHERE ts >= TIMESTAMP '2024-01-03 05:06:07' AND ts < TIMESTAMP '2024-01-19 23:59:59') SELECT * FROM ({_SUMMARY}) {_LONG}",
)
def ts_pyramid(t):
    """Sums of the points of a range that cuts buckets at both ends."""
    start, end = datetime(2024, 1, 3, 5, 6, 7), datetime(2024, 1, 19, 23, 59, 59)
    return rounded(Py.range_summary(updated_pyramid(t), t.events, "event_type", "ts", "value", start, end, 3600, weighted=False))
