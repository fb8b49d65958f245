"""Queries over scalar functions and typed projection."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import coercion as C
from tidemark.functions import scalars as S
from tidemark.registry.base import query


@query("epoch_ms", "SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('millisecond', ts) END AS at FROM events")
def epoch_ms(t):
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    raw = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(ms)
    return t.events.select("event_id", S.epoch_ms_to_ts(raw).alias("at"))


@query(
    "odata_date",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y-%m-%d')
                            ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS at FROM orders
    """,
)
def odata_date(t):
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("string")
    raw = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("/Date("), ms, F.lit(")/")))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("/Date("), ms, F.lit("+0100)/")))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    return t.orders.select("o_orderkey", S.odata_date(raw).alias("at"))


@query(
    "yyyymmdd",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
           CASE WHEN o_orderstatus <> 'P' THEN strftime(greatest(o_orderdate - INTERVAL 30 DAY, TIMESTAMP '1996-01-01'), '%Y-%m-%d') END AS earlier
    FROM orders
    """,
)
def yyyymmdd(t):
    digits = F.when(F.col("o_orderstatus") == "P", F.lit("20231315")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    day = S.yyyymmdd(digits)
    return t.orders.select("o_orderkey", day.alias("day"), S.shift_day(day, -30, "1996-01-01").alias("earlier"))


@query(
    "parse_ts_any",
    """
    SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN date_trunc('day', ts)
             WHEN 'view' THEN date_trunc('second', ts) - INTERVAL 2 HOUR ELSE date_trunc('second', ts) END AS at
    FROM events
    """,
)
def parse_ts_any(t):
    base = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    kind = F.col("event_type")
    raw = (
        F.when(kind == "error", F.concat(base, F.lit(" o'clock")))
        .when(kind == "click", F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == "view", F.concat(base, F.lit("+02:00")))
        .otherwise(F.concat(base, F.lit("Z")))
    )
    return t.events.select("event_id", S.parse_ts_any(raw).alias("at"))


@query(
    "relative_time",
    """
    SELECT event_id, CASE event_type WHEN 'click' THEN TIMESTAMP '2024-03-01' - to_days(CAST(value AS INTEGER))
             WHEN 'view' THEN TIMESTAMP '2024-03-01' - to_hours(CAST(value AS INTEGER))
             WHEN 'purchase' THEN TIMESTAMP '2024-03-01' - to_minutes(CAST(value AS INTEGER))
             ELSE TIMESTAMP '2024-03-01' END AS at
    FROM (SELECT event_id, event_type, floor(value) AS value FROM events)
    """,
)
def relative_time(t):
    n = F.floor("value").cast("string")
    unit = F.when(F.col("event_type") == "click", "d").when(F.col("event_type") == "view", "h").when(
        F.col("event_type") == "purchase", "m"
    )
    raw = F.coalesce(F.concat(F.lit("*-"), n, unit), F.when(F.col("event_type") == "error", F.lit("soon")).otherwise(F.lit("*")))
    now = F.lit("2024-03-01").cast("timestamp")
    return t.events.select("event_id", S.relative_time(raw, now).alias("at"))


@query("apply_lookback", "SELECT event_id, ts - INTERVAL 300 SECOND AS low FROM events")
def apply_lookback(t):
    return t.events.select("event_id", S.apply_lookback(F.col("ts"), 300).alias("low"))


@query("window_end", "SELECT event_id, least(ts + INTERVAL 86400 SECOND, TIMESTAMP '2024-01-20') AS high FROM events")
def window_end(t):
    cap = F.lit("2024-01-20").cast("timestamp_ntz")
    return t.events.select("event_id", S.window_end(F.col("ts"), 86400, cap).alias("high"))


@query(
    "time_range",
    """
    WITH r AS (SELECT event_id, least(coalesce(CASE WHEN event_type = 'click' THEN ts END,
                 CASE WHEN event_type = 'view' THEN ts + INTERVAL 7 DAY END, TIMESTAMP '2024-01-25' - INTERVAL 1 DAY),
                 TIMESTAMP '2024-01-25') AS range_start FROM events)
    SELECT event_id, range_start, least(range_start + INTERVAL 6 HOUR, TIMESTAMP '2024-01-25') AS range_end FROM r
    """,
)
def time_range(t):
    stored = F.when(F.col("event_type") == "click", F.col("ts"))
    option = F.when(F.col("event_type") == "view", F.col("ts") + F.expr("INTERVAL 7 DAYS"))
    start, end = S.time_range(stored, option, F.lit("2024-01-25").cast("timestamp_ntz"), 86400, 6 * 3600)
    return t.events.select("event_id", start.alias("range_start"), end.alias("range_end"))


_WORD = "CASE o_orderpriority WHEN '1-URGENT' THEN ' Yes ' WHEN '2-HIGH' THEN 'T' WHEN '3-MEDIUM' THEN 'no' WHEN '4-NOT SPECIFIED' THEN 'maybe' ELSE '' END"


@query(
    "as_bool",
    f"""
    WITH w AS (SELECT o_orderkey, {_WORD} AS word FROM orders)
    SELECT o_orderkey, CASE WHEN lower(trim(word)) IN ('true','t','1','yes','y') THEN true
                            WHEN lower(trim(word)) IN ('false','f','0','no','n') THEN false ELSE false END AS flag,
           CASE WHEN lower(word) IN ('true','t','1','yes','y') THEN true
                WHEN lower(word) IN ('false','f','0','no','n') THEN false ELSE length(word) > 0 END AS truthy
    FROM w
    """,
)
def as_bool(t):
    word = F.expr(_WORD)
    return t.orders.select("o_orderkey", S.as_bool(word, False).alias("flag"), C.to_boolean(word).alias("truthy"))


@query(
    "try_numbers",
    """
    WITH n AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN CAST(o_totalprice AS VARCHAR)
                 WHEN 'O' THEN ' ' || CAST(o_custkey AS VARCHAR) || ' ' ELSE 'n/a' END AS raw, o_orderstatus, o_totalprice, o_custkey FROM orders)
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_totalprice WHEN 'O' THEN CAST(o_custkey AS DOUBLE) END AS real,
           CASE WHEN o_orderstatus = 'O' THEN o_custkey END AS whole FROM n
    """,
)
def try_numbers(t):
    raw = F.expr(
        """CASE o_orderstatus WHEN 'F' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)
           WHEN 'O' THEN ' ' || CAST(o_custkey AS STRING) || ' ' ELSE 'n/a' END"""
    )
    return t.orders.select("o_orderkey", S.try_double(raw).alias("real"), S.try_long(raw).alias("whole"))


@query(
    "metric_value",
    """
    SELECT event_id, CASE WHEN event_type = 'click' THEN CAST(floor(value) AS BIGINT) END AS whole,
           CASE WHEN event_type = 'view' THEN value END AS real,
           CASE WHEN event_type NOT IN ('click', 'view', 'error') THEN event_type END AS text FROM events
    """,
)
def metric_value(t):
    kind = F.expr("CASE event_type WHEN 'click' THEN 'TYPE_INTEGER' WHEN 'view' THEN 'TYPE_CURRENCY' ELSE 'TYPE_STRING' END")
    raw = F.expr(
        """CASE event_type WHEN 'click' THEN CAST(floor(value) AS STRING) WHEN 'view' THEN CAST(value AS STRING)
           WHEN 'error' THEN '' ELSE event_type END"""
    )
    whole, real, text = S.metric_value(raw, kind)
    return t.events.select("event_id", whole.alias("whole"), real.alias("real"), text.alias("text"))


@query(
    "snake_case",
    """
    SELECT p_partkey, lower(regexp_replace(regexp_replace(w, '(.)([A-Z][a-z]+)', '\\1_\\2', 'g'), '([a-z0-9])([A-Z])', '\\1_\\2', 'g')) AS name
    FROM (SELECT p_partkey, replace(p_brand, '#', 'Id') || upper(left(p_name, 1)) || substr(split_part(p_name, ' ', 1), 2) || 'JSONText' AS w FROM part)
    """,
)
def snake_case(t):
    word = F.expr(
        "replace(p_brand, '#', 'Id') || upper(left(p_name, 1)) || substr(split_part(p_name, ' ', 1), 2) || 'JSONText'"
    )
    return t.part.select("p_partkey", S.snake_case(word).alias("name"))


@query(
    "sanitize_name",
    """
    SELECT p_partkey, CASE WHEN b = '' THEN '_col' || p_size ELSE b END AS name FROM (
      SELECT p_partkey, p_size, regexp_replace(regexp_replace(trim(raw), '[^a-zA-Z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS b
      FROM (SELECT p_partkey, p_size, CASE WHEN p_type = 'ECONOMY' THEN ' ## ' ELSE ' ' || p_brand || ' / ' || p_name || '!' END AS raw FROM part))
    """,
)
def sanitize_name(t):
    raw = F.expr("CASE WHEN p_type = 'ECONOMY' THEN ' ## ' ELSE ' ' || p_brand || ' / ' || p_name || '!' END")
    return t.part.select("p_partkey", S.sanitize_name(raw, F.col("p_size")).alias("name"))


@query(
    "redact_email",
    """
    SELECT doc_id, md5(regexp_replace(text, '[A-Za-z0-9][A-Za-z0-9._+-]*@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)+', 'redacted@example.com', 'g')) AS digest
    FROM documents
    """,
)
def redact_email(t):
    return t.documents.select("doc_id", F.md5(S.redact_email(F.col("text")).cast("binary")).alias("digest"))


@query(
    "redact_secret",
    """
    SELECT page_id, CASE WHEN page_id IS NOT NULL AND contains(url, 'example') THEN '***REDACTED***' ELSE url END AS shown FROM pages
    """,
)
def redact_secret(t):
    name = F.when(F.contains("url", F.lit("example")), "Authorization").otherwise("Accept")
    return t.pages.select("page_id", S.redact_secret(name, F.col("url")).alias("shown"))


@query("decode_binary", "SELECT doc_id, md5(text) AS from_base64, md5(text) AS from_hex, md5('é' || lang) AS from_text FROM documents")
def decode_binary(t):
    """Whole texts through base64 and hex and back."""
    text = F.encode("text", "UTF-8")
    # a hex text of odd base64 length is not base64
    odd = F.concat(F.hex(text), F.when(F.pmod(F.length(F.hex(text)), F.lit(4)) == 0, F.lit(" 0A")).otherwise(F.lit("")))
    back = S.decode_binary(odd)
    cut = F.when(F.endswith(odd, F.lit(" 0A")), F.substring(back, F.lit(1), F.length(back) - 1)).otherwise(back)
    return t.documents.select(
        "doc_id",
        F.md5(S.decode_binary(F.base64(text))).alias("from_base64"),
        F.md5(cut).alias("from_hex"),
        F.md5(S.decode_binary(F.concat(F.lit("é"), "lang"))).alias("from_text"),
    )


@query(
    "csv_list",
    """
    SELECT p_partkey, trim(p_name) || '|' || trim(p_brand) AS items,
           2 AS n_json, 1 AS n_plain FROM part
    """,
)
def csv_list(t):
    items = S.csv_list(F.concat("p_name", F.lit(", , "), "p_brand", F.lit(" ,")))
    listed = S.text_list(F.to_json(F.array("p_name", "p_brand")))
    return t.part.select(
        "p_partkey",
        F.array_join(items, "|").alias("items"),
        F.size(listed).alias("n_json"),
        F.size(S.text_list(F.col("p_name"))).alias("n_plain"),
    )


@query(
    "person_name",
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN c_mktsegment ELSE c_name END AS name FROM customer",
)
def person_name(t):
    name = F.struct(
        F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_name")).alias("Alphabetic"),
        F.col("c_mktsegment").alias("Ideographic"),
        F.lit(None).cast("string").alias("Phonetic"),
    )
    return t.customer.select("c_custkey", S.person_name(name).alias("name"))


@query(
    "valid_uid",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag <> 'R' AND l_linestatus <> 'O' AS ok FROM lineitem
    """,
)
def valid_uid(t):
    uid = F.concat_ws(".", F.lit("1"), F.col("l_orderkey"), F.col("l_partkey"))
    uid = F.when(F.col("l_returnflag") == "R", F.concat(uid, F.lit("..9"))).otherwise(uid)
    uid = F.when(F.col("l_linestatus") == "O", F.concat(uid, F.lit(".x"))).otherwise(uid)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", S.valid_uid(uid).alias("ok"))


@query("record_fingerprint", "SELECT doc_id, sha256('=' || lang || chr(31) || '=' || text || chr(31) || '~') AS print FROM documents")
def record_fingerprint(t):
    return t.documents.select(
        "doc_id", S.record_fingerprint(F.col("lang"), F.col("text"), F.lit(None).cast("string")).alias("print")
    )


@query(
    "json_or_null",
    "SELECT event_id, CASE WHEN event_type <> 'error' THEN '{\"type\":\"' || event_type || '\",\"user\":' || user_id || '}' END AS doc FROM events",
)
def json_or_null(t):
    rec = F.when(
        F.col("event_type") != "error", F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user"))
    )
    return t.events.select("event_id", S.json_or_null(rec).alias("doc"))


@query("preview_text", "SELECT doc_id, left(text, 80) AS head FROM documents")
def preview_text(t):
    return t.documents.select("doc_id", S.preview(F.col("text"), 80).alias("head"))


@query("safe_path", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, NULL::VARCHAR AS deep FROM events")
def safe_path(t):
    return t.events.select(
        "event_id",
        S.safe_path(F.col("props"), "k", kind="bigint").alias("k"),
        S.safe_path(F.col("props"), "k", "none").alias("deep"),
    )


RAW_EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType(), False),
        T.StructField("amount", T.LongType()),
        T.StructField("real", T.DoubleType()),
        T.StructField("active", T.BooleanType()),
        T.StructField("day", T.DateType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("props", T.StructType([T.StructField("k", T.LongType())])),
    ]
)


@query(
    "coerce_types",
    """
    SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(trunc(value) AS BIGINT) END AS amount, value AS real,
           event_type NOT IN ('view') AS active, CAST(ts AS DATE) AS day, date_trunc('second', ts) AS at,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS INTEGER) AS bad
    FROM events
    """,
)
def coerce_types(t):
    raw = t.events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_type") == "error", "x1").otherwise(F.col("value").cast("decimal(12,2)").cast("string")).alias("amount"),
        F.col("value").cast("string").alias("real"),
        F.when(F.col("event_type") == "view", "No").when(F.col("event_type") == "click", "Y").otherwise("sure").alias("active"),
        F.when(F.col("event_type") == "view", F.date_format("ts", "MM/dd/yyyy")).otherwise(F.date_format("ts", "yyyy/M/d")).alias("day"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"),
        "props",
    )
    out = C.coerce(raw, RAW_EVENT)
    return out.select("event_id", "amount", "real", "active", "day", "at", "props.k", F.size(C.ERRORS).alias("bad"))


@query(
    "coerce_descriptors",
    "SELECT o_orderkey AS id, o_totalprice AS price, CAST(o_orderdate AS DATE) AS day, o_orderstatus = 'F' AS done, o_orderpriority AS rank FROM orders",
)
def coerce_descriptors(t):
    """Target types from a descriptor table; the unknown type stays text."""
    schema = C.schema_from_descriptors(
        [
            {"name": "id", "type": "integer", "nullable": False},
            {"name": "price", "type": "decimal", "precision": 60, "scale": 2},
            {"name": "day", "type": "date"},
            {"name": "done", "type": "boolean"},
            {"name": "rank", "type": "picklist"},
        ]
    )
    raw = t.orders.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.when(F.col("o_orderstatus") == "F", "yes").otherwise("no").alias("done"),
        F.col("o_orderpriority").alias("rank"),
    )
    return C.coerce(raw, schema, "strict")
