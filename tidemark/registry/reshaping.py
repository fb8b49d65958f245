"""Queries over projections, reshaping and unnesting."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import explode as X
from tidemark.operators import reshape as R
from tidemark.registry.base import query


@query(
    "conform_struct",
    "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_totalprice, NULL::VARCHAR AS o_comment FROM orders",
)
def conform_struct(t):
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType(), False),
            T.StructField("o_custkey", T.StringType()),
            T.StructField("o_totalprice", T.DoubleType()),
            T.StructField("o_comment", T.StringType()),
        ]
    )
    return R.conform_struct(t.orders, schema)


@query(
    "wrap_array",
    "SELECT p_partkey, 1 AS n, p_name AS first_item, 2 AS n_variant FROM part",
)
def wrap_array(t):
    wrapped = R.wrap_array(F.col("p_name"))
    listed = R.wrap_array(F.parse_json(F.to_json(F.array("p_name", "p_brand"))), T.VariantType())
    return t.part.select(
        "p_partkey", F.size(wrapped).alias("n"), wrapped[0].alias("first_item"), F.size(listed).alias("n_variant")
    )


def envelopes(t):
    """Events as nested envelope JSON with a kind."""
    doc = F.struct(
        F.concat(F.lit("part:"), F.col("event_id")).alias("id"),
        F.concat(F.lit("src:wks:master-data--"), F.initcap("event_type"), F.lit(":1.0.0")).alias("kind"),
        F.col("event_id").cast("string").alias("version"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("createTime"),
        F.when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd")).alias("modifyTime"),
        F.struct(F.array(F.lit("owner"), F.col("event_type")).alias("owners"), F.lit("all").alias("viewers")).alias("acl"),
        F.struct(F.col("value").alias("Depth"), F.col("user_id").alias("RunNumber"), F.col("event_type").alias("Name")).alias("data"),
    )
    return t.events.select(F.to_json(doc).alias("raw"))


ENVELOPE_FIELDS = {
    "id": ("id", "text"),
    "version": ("version", "long"),
    "modify_time": ("modifyTime|createTime", "text"),
    "owners": ("acl.owners", "list"),
    "viewers": ("acl.viewers", "list"),
}
ENVELOPE_KINDS = {
    "master-data--Click": {"click_depth": ("data.Depth", "double")},
    "master-data--View": {"view_run": ("data.RunNumber", "text")},
}


@query(
    "flatten_envelope",
    """
    SELECT 'part:' || event_id AS id, event_id AS version,
           CASE WHEN event_type = 'view' THEN strftime(ts, '%Y-%m-%d') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS modify_time,
           'owner,' || event_type AS owners, 'all' AS viewers,
           CASE WHEN event_type = 'click' THEN value END AS click_depth,
           CASE WHEN event_type = 'view' THEN CAST(user_id AS VARCHAR) END AS view_run
    FROM events
    """,
)
def flatten_envelope(t):
    flat = R.flatten_envelope(envelopes(t), "raw", ENVELOPE_FIELDS, ENVELOPE_KINDS)
    return flat.withColumns({"owners": F.array_join("owners", ","), "viewers": F.array_join("viewers", ",")})


@query(
    "rename_map",
    "SELECT o_orderkey AS id, o_custkey AS customer_id, o_orderstatus AS allowed_status, NULL::VARCHAR AS missing FROM orders",
)
def rename_map(t):
    nested = t.orders.select(
        F.col("o_orderkey").alias("orderKey"),
        F.col("o_custkey").alias("customerId"),
        F.struct(F.col("o_orderstatus").alias("canStatus")).alias("allowedActions"),
    )
    return R.rename_map(
        nested,
        {"orderKey": "id", "customerId": "customer_id", "allowedActions.canStatus": "allowed_status", "allowedActions.no": "missing"},
    )


@query(
    "snake_case_columns",
    "SELECT o_orderkey AS order_key, o_custkey AS customer_id, o_orderstatus AS status_code FROM orders",
)
def snake_case_columns(t):
    nested = t.orders.select(
        F.col("o_orderkey").alias("orderKey"),
        F.array(F.struct(F.col("o_custkey").alias("customerID"), F.col("o_orderstatus").alias("StatusCode"))).alias("orderParts"),
    )
    out = R.snake_case_columns(nested)
    return out.select("order_key", F.inline("order_parts"))


@query(
    "sanitize_columns",
    'SELECT c_custkey AS "Cust_Key", c_name AS _col1, c_mktsegment AS "Seg_ment_x", c_acctbal AS "Cust_Key_3" FROM customer',
)
def sanitize_columns(t):
    raw = t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal").toDF("Cust Key", " ", "#Seg/ment%x ", "Cust-Key")
    return R.sanitize_columns(raw)


@query(
    "json_stringify",
    """SELECT event_id, '{"user":' || user_id || ',"type":"' || event_type || '"}' AS actor FROM events""",
)
def json_stringify(t):
    rows = t.events.select("event_id", F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("type")).alias("actor"))
    return R.json_stringify(rows, ["actor"])


@query(
    "split_properties",
    """
    SELECT event_id, json_extract_string(props, '$.k') AS known_k, event_type AS city, CAST(user_id AS VARCHAR) AS custom_user, 1 AS n_custom
    FROM events
    """,
)
def split_properties(t):
    props = F.to_json(
        F.map_from_arrays(
            F.array(F.lit("k"), F.lit("$city"), F.lit("user")),
            F.array(F.get_json_object("props", "$.k"), F.col("event_type"), F.col("user_id").cast("string")),
        )
    )
    out = R.split_properties(t.events.select("event_id", props.alias("props")), "props", ["k", "$city", "$os"])
    return out.select(
        "event_id",
        F.col("properties.k").alias("known_k"),
        F.col("properties.`$city`").alias("city"),
        F.try_element_at("properties.custom_properties", F.lit("user")).alias("custom_user"),
        F.size("properties.custom_properties").alias("n_custom"),
    )


@query(
    "blank_to_null",
    """
    SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS segment,
           CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS mapped,
           CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS nested FROM customer
    """,
)
def blank_to_null(t):
    name = F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_name"))
    rows = t.customer.select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment")).alias("segment"),
        F.create_map(F.lit("name"), name).alias("mapped"),
        F.struct(name.alias("name")).alias("nested"),
    )
    out = R.blank_to_null(rows)
    return out.withColumns({"mapped": F.col("mapped")["name"], "nested": F.col("nested.name")})


@query(
    "empty_struct_to_null",
    "SELECT o_orderkey, o_orderstatus = 'F' AS gone, CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS cust FROM orders",
)
def empty_struct_to_null(t):
    kept = F.col("o_orderstatus") != "F"
    rows = t.orders.select(
        "o_orderkey", F.struct(F.struct(F.when(kept, F.col("o_custkey")).alias("id")).alias("who")).alias("info")
    )
    out = R.empty_struct_to_null(rows, ["info"])
    return out.select("o_orderkey", F.col("info").isNull().alias("gone"), F.col("info.who.id").alias("cust"))


@query(
    "coalesce_paths",
    "SELECT event_id, CASE event_type WHEN 'click' THEN 'top' WHEN 'view' THEN 'inner' ELSE 'other' END AS found FROM events",
)
def coalesce_paths(t):
    kind = F.col("event_type")
    raw = (
        F.when(kind == "click", F.lit('{"status":"top","values":{"status":"inner"}}'))
        .when(kind == "view", F.lit('{"values":{"status":"inner"},"Status":"other"}'))
        .otherwise(F.lit('{"Status":"other"}'))
    )
    out = R.coalesce_paths(t.events.select("event_id", raw.alias("raw")), "found", "raw", ["status", "values.status", "Status"])
    return out.drop("raw")


@query("drop_metadata_keys", "SELECT o_orderkey, o_custkey AS cust_id, o_orderstatus AS cust_status, 2 AS n_fields FROM orders")
def drop_metadata_keys(t):
    link = F.struct(F.lit("uri").alias("uri"))
    rows = t.orders.select(
        F.struct(F.lit("Order").alias("type")).alias("__metadata"),
        "o_orderkey",
        F.struct(link.alias("__deferred")).alias("lines"),
        F.struct(
            link.alias("__metadata"),
            F.col("o_custkey").alias("id"),
            F.col("o_orderstatus").alias("status"),
            F.struct(link.alias("__deferred")).alias("nation"),
        ).alias("cust"),
    )
    out = R.drop_metadata_keys(rows)
    return out.select(
        "o_orderkey",
        F.col("cust.id").alias("cust_id"),
        F.col("cust.status").alias("cust_status"),
        F.lit(len(out.columns)).alias("n_fields"),
    )


@query(
    "with_context",
    "SELECT o_orderkey, 'acme' AS owner, 'shop-1' AS shop, TIMESTAMP '2024-02-01' AS ingested_at FROM orders",
)
def with_context(t):
    at = F.lit(datetime(2024, 2, 1)).cast("timestamp_ntz")
    return R.with_context(t.orders.select("o_orderkey"), owner="acme", shop="shop-1", ingested_at=at)


@query(
    "associations",
    "SELECT o_orderkey, o_custkey || ',' AS results_form, CAST(o_custkey AS VARCHAR) AS bare_form FROM orders",
)
def associations(t):
    linked = F.struct(
        F.array(
            F.struct(F.col("o_custkey").alias("id")), F.struct(F.lit(None).cast("long").alias("id"))
        ).alias("results")
    )
    rows = t.orders.select("o_orderkey", linked.alias("a"), F.array("o_custkey").alias("b"))
    return rows.select(
        "o_orderkey",
        F.array_join(R.associations(F.col("a"), rows.schema["a"].dataType), ",").alias("results_form"),
        F.array_join(R.associations(F.col("b"), rows.schema["b"].dataType), ",").alias("bare_form"),
    )


def responses(t):
    """Labelled documents as survey responses with answers and stray metadata among them."""
    doc = F.struct(
        F.when(F.col("toxic") == 0, F.concat(F.lit("R_"), F.col("doc_id"))).alias("responseId"),
        F.struct(
            F.struct(F.concat(F.lit("R_"), F.col("doc_id")).alias("textEntry")).alias("_recordId"),
            F.lit("done").alias("status"),
            F.struct(F.col("quality").cast("string").alias("choiceId"), F.lit("quality").alias("choiceText")).alias("QID1"),
            F.col("toxic").alias("QID2"),
        ).alias("values"),
    )
    return t.labels.select("doc_id", F.to_json(doc).alias("raw"))


@query(
    "question_values",
    """
    SELECT doc_id, 'QID1' AS question, CAST(quality AS VARCHAR) AS choice_id, 'quality' AS choice_text, NULL::VARCHAR AS text_entry FROM labels
    UNION ALL SELECT doc_id, 'QID2', NULL, NULL, CAST(toxic AS VARCHAR) FROM labels
    """,
)
def question_values(t):
    rows = responses(t).select("doc_id", R.question_values(F.get_json_object("raw", "$.values")).alias("answers"))
    return X.explode_map(rows, "answers", ["doc_id"], "question", "answer").select(
        "doc_id",
        "question",
        F.col("answer.choiceId").alias("choice_id"),
        F.col("answer.choiceText").alias("choice_text"),
        F.col("answer.textEntry").alias("text_entry"),
    )


@query("response_fields", "SELECT doc_id, 'R_' || doc_id AS response_id, 'done' AS status, NULL::VARCHAR AS user_language FROM labels")
def response_fields(t):
    return R.response_fields(responses(t), "raw").select("doc_id", "response_id", "status", "user_language")


@query(
    "hybrid_record",
    """
    SELECT event_id AS id, value, '{"id":' || event_id || ',"extension":[{"url":"u","v":"' || event_type || '"}]}' AS raw_json,
           '[{"url":"u","v":"' || event_type || '"}]' AS extension FROM events
    """,
)
def hybrid_record(t):
    ext = F.array(F.struct(F.lit("u").alias("url"), F.col("event_type").alias("v")))
    raw = F.to_json(F.struct(F.col("event_id").alias("id"), ext.alias("extension")))
    rows = t.events.select("event_id", "value", raw.alias("raw"))
    return R.hybrid_record(rows, {"id": F.col("event_id"), "value": F.col("value")}, "raw")


@query("extension_lookup", "SELECT c_custkey, c_mktsegment AS found, NULL::VARCHAR AS absent FROM customer")
def extension_lookup(t):
    ext = F.array(
        F.struct(F.lit("urn:name").alias("url"), F.col("c_name").alias("value")),
        F.struct(F.lit("urn:segment").alias("url"), F.col("c_mktsegment").alias("value")),
        F.struct(F.lit("urn:segment").alias("url"), F.lit("second").alias("value")),
    )
    return t.customer.select(
        "c_custkey",
        R.extension_lookup(ext, "urn:segment")["value"].alias("found"),
        R.extension_lookup(ext, "urn:none")["value"].alias("absent"),
    )


def tagged(t):
    """Orders as tag-keyed image study JSON."""
    value = lambda vr, *v: F.struct(F.lit(vr).alias("vr"), F.array(*v).alias("Value"))
    name = F.struct(
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("Doe^"), F.col("o_custkey"))).alias("Alphabetic"),
        F.lit("ideo").alias("Ideographic"),
    )
    doc = F.struct(
        value("UI", F.concat(F.lit("1.2."), F.col("o_orderkey"))).alias("0020000D"),
        value("DA", F.date_format("o_orderdate", "yyyyMMdd")).alias("00080020"),
        value("PN", name).alias("00100010"),
        value("CS", F.lit("CT"), F.col("o_orderstatus")).alias("00080061"),
        value("IS", F.when(F.col("o_orderstatus") == "F", "bad").otherwise(F.col("o_custkey").cast("string"))).alias("00201206"),
        F.struct(F.lit("LO").alias("vr")).alias("00081030"),
    )
    return t.orders.select("o_orderkey", F.to_json(doc).alias("raw"))


STUDY_TAGS = {
    "0020000D": ("study_uid", "text"),
    "00080020": ("study_date", "text"),
    "00100010": ("patient_name", "name"),
    "00080061": ("modalities", "list"),
    "00201206": ("n_series", "long"),
    "00081030": ("description", "text"),
}


@query(
    "tag_extract",
    """
    SELECT o_orderkey, '1.2.' || o_orderkey AS study_uid, strftime(o_orderdate, '%Y%m%d') AS study_date,
           CASE WHEN o_orderstatus <> 'P' THEN 'Doe^' || o_custkey ELSE 'ideo' END AS patient_name,
           'CT,' || o_orderstatus AS modalities, CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS n_series,
           NULL::VARCHAR AS description FROM orders
    """,
)
def tag_extract(t):
    out = R.tag_extract(tagged(t), "raw", STUDY_TAGS)
    return out.withColumn("modalities", F.array_join("modalities", ","))


def stream_sets(t):
    """Events as stream-set JSON, one stream per event; error events lack a time."""
    item = F.struct(
        F.when(F.col("event_type") != "error", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("Timestamp"),
        F.when(F.col("event_type") == "view", F.lit("Bad Input")).otherwise(F.col("value").cast("string")).alias("Value"),
        F.when(F.col("event_type") == "click", F.lit(False)).alias("Good"),
    )
    stream = F.struct(F.col("event_type").alias("WebId"), F.array(item).alias("Items"))
    return t.events.select(F.to_json(F.struct(F.array(stream).alias("Items"))).alias("raw"))


@query(
    "recorded_values",
    """
    SELECT event_type AS tag_webid, date_trunc('second', ts) AS timestamp, CASE WHEN event_type <> 'view' THEN value END AS value,
           event_type <> 'click' AS good, false AS questionable, '' AS units FROM events WHERE event_type <> 'error'
    """,
)
def recorded_values(t):
    return R.recorded_values(stream_sets(t), "raw").drop("substituted", "annotated")


@query(
    "map_all_to_string",
    "SELECT event_id, CAST(user_id AS VARCHAR) AS u, CASE WHEN event_type = 'error' THEN '' ELSE CAST(event_id AS VARCHAR) END AS e FROM events",
)
def map_all_to_string(t):
    m = F.create_map(
        F.lit("u"), F.col("user_id"), F.lit("e"), F.when(F.col("event_type") != "error", F.col("event_id"))
    )
    text = R.map_all_to_string(m)
    return t.events.select("event_id", text["u"].alias("u"), text["e"].alias("e"))


@query("get_path", "SELECT event_id, user_id AS who, NULL::VARCHAR AS missing, event_type || '!' AS changed FROM events")
def get_path(t):
    rows = t.events.select("event_id", F.struct(F.struct(F.col("user_id").alias("id"), "event_type").alias("b")).alias("a"))
    out = R.get_path(R.get_path(rows, "a.b.id", "who"), "a.x.y", "missing")
    out = R.set_path(out, "a.b.event_type", F.concat("a.b.event_type", F.lit("!")))
    return out.select("event_id", "who", "missing", F.col("a.b.event_type").alias("changed"))


@query("hoist", "SELECT o_orderkey, 'https://host/' || o_custkey || '/' || o_orderkey || '/' || o_orderstatus AS url FROM orders")
def hoist(t):
    rows = t.orders.select("o_orderkey", "o_custkey", F.struct("o_orderstatus").alias("ref"))
    return R.hoist(rows, "ref.o_orderstatus", "url", "https://host/", ["o_custkey", "o_orderkey"]).select("o_orderkey", "url")


@query(
    "survey_definition",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS survey_id, p_name AS survey_name, strftime(DATE '2024-01-01' + p_size, '%Y-%m-%dT00:00:00Z') AS last_modified,
           '{"brand":"' || p_brand || '"}' AS survey_flow FROM part WHERE DATE '2024-01-01' + p_size > DATE '2024-01-20'
    """,
)
def survey_definition(t):
    at = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")), "yyyy-MM-dd'T'00:00:00'Z'")
    raw = F.to_json(
        F.struct(
            F.col("p_partkey").alias("SurveyID"),
            F.col("p_name").alias("SurveyName"),
            at.alias("LastModified"),
            F.struct(F.col("p_brand").alias("brand")).alias("SurveyFlow"),
        )
    )
    return R.survey_definition(
        t.part.select(raw.alias("raw")), "raw", ["SurveyID", "SurveyName", "LastModified"], ["SurveyFlow"], "LastModified", "2024-01-20"
    )


@query("select_fields", "SELECT event_id, user_id AS actor_user_id, value FROM events")
def select_fields(t):
    rows = t.events.select("event_id", "ts", "value", F.struct("user_id", "event_type").alias("actor"))
    return R.select_fields(rows, ["event_id", "actor.user_id", "value"])


@query("explode_children", "SELECT conv_id AS conversation_id, turn, role, text FROM conversations")
def explode_children(t):
    """Each turn as a child list entry of its conversation row."""
    rows = t.conversations.select("conv_id", F.array(F.struct("turn", "role", "text")).alias("turns"))
    return X.explode_children(rows, "turns", {"conv_id": "conversation_id"})


@query(
    "explode_filtered",
    """
    SELECT event_id AS id, coalesce(CASE WHEN event_type = 'click' THEN TIMESTAMP '2024-02-01' END, ts) AS created, event_type AS body FROM events
    """,
)
def explode_filtered(t):
    child = lambda kind, at: F.struct(F.lit(kind).alias("kind"), at.alias("created"), F.col("event_type").alias("body"))
    late = F.when(F.col("event_type") == "click", F.lit(datetime(2024, 2, 1)).cast("timestamp_ntz"))
    rows = t.events.select(
        F.col("event_id").alias("id"), F.col("ts").alias("created"),
        F.array(child("Change", F.col("ts")), child("Comment", late)).alias("child_events"),
    )
    return X.explode_filtered(rows, "child_events", lambda c: c["kind"] == "Comment", ["id", "created"]).drop("kind")


@query(
    "explode_two_level",
    """
    SELECT doc_id AS survey_id, p AS page_id, q AS question_id, quality FROM labels, (SELECT unnest([1, 2]) AS p), (SELECT unnest([10, 20]) AS q)
    """,
)
def explode_two_level(t):
    question = lambda n: F.struct(F.lit(n).alias("question_id"), F.col("quality"))
    a_page = lambda n: F.struct(F.lit(n).alias("id"), F.array(question(10), question(20)).alias("questions"))
    rows = t.labels.select("doc_id", F.array(a_page(1), a_page(2)).alias("pages"))
    return X.explode_two_level(rows, "pages", "questions", {"doc_id": "survey_id"}, "id", "page_id")


@query("explode_envelope_dates", "SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, event_id, value FROM events")
def explode_envelope_dates(t):
    entry = F.struct(
        F.col("user_id").alias("userId"), F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.array(F.struct("event_id", "value")).alias("records"),
    )
    rows = t.events.select(F.array(entry).alias("data"))
    return X.explode_envelope_dates(rows, "data", "records", {"userId": "user_id", "date": "day"})


@query("explode_parts", "SELECT p_partkey, p_retailprice AS hourly_rate, p_size AS from_day FROM part")
def explode_parts(t):
    rates = F.array(F.struct(F.col("p_retailprice").alias("hourlyRate"), F.col("p_size").alias("fromDay")))
    parts = X.explode_parts(rates, {"hourlyRate": "hourly_rate", "fromDay": "from_day"})
    return t.part.select("p_partkey", F.inline(parts))


@query("explode_map", "SELECT event_id, 'k' AS key, json_extract_string(props, '$.k') AS value FROM events")
def explode_map(t):
    rows = t.events.select("event_id", F.from_json("props", "map<string,string>").alias("m"))
    return X.explode_map(rows, "m", ["event_id"])


@query(
    "reshape_records",
    """
    SELECT event_id, CASE WHEN event_type = 'error' THEN 'not set' ELSE strftime(ts, '%Y-%m-%d') END AS date, event_type AS "eventName",
           CAST(user_id AS BIGINT) AS hits, CASE WHEN event_type = 'view' THEN NULL ELSE value END AS revenue, NULL::VARCHAR AS note FROM events
    """,
)
def reshape_records(t):
    day = F.when(F.col("event_type") == "error", "not set").otherwise(F.date_format("ts", "yyyyMMdd"))
    blank = F.when(F.col("event_type") == "view", "").otherwise(F.col("value").cast("string"))
    rows = t.events.select(
        "event_id", F.array(day, F.col("event_type")).alias("d"), F.array(F.col("user_id").cast("string"), blank).alias("m")
    )
    metrics = {"hits": "TYPE_INTEGER", "revenue": "TYPE_CURRENCY", "note": "TYPE_STRING"}
    return X.reshape_records(rows, ["date", "eventName"], metrics, "d", "m")


def bundles(t):
    """One bundle page per customer: a resource entry and an entry without resource."""
    page = F.to_json(
        F.struct(
            F.lit("Bundle").alias("resourceType"),
            F.array(
                F.struct(
                    F.struct(
                        F.lit("Patient").alias("resourceType"),
                        F.concat(F.lit("p"), F.col("c_custkey")).alias("id"),
                        F.col("c_mktsegment").alias("gender"),
                    ).alias("resource")
                ),
                F.struct(
                    F.lit(None).cast("struct<resourceType:string,id:string,gender:string>").alias("resource")
                ),
            ).alias("entry"),
        )
    )
    return t.customer.select("c_custkey", page.alias("raw"))


@query("bundle_entries", "SELECT c_custkey, 'p' || c_custkey AS id, c_mktsegment AS gender FROM customer")
def bundle_entries(t):
    rows = X.bundle_entries(bundles(t), "raw")
    return rows.select(
        "c_custkey",
        F.get_json_object("resource", "$.id").alias("id"),
        F.get_json_object("resource", "$.gender").alias("gender"),
    )


@query(
    "explode_structs",
    """
    SELECT c_custkey, c_name AS family, c_acctbal AS systolic, NULL::DOUBLE AS third, c_mktsegment AS code FROM customer
    WHERE c_mktsegment = 'MACHINERY'
    UNION ALL
    SELECT c_custkey, 'alias', c_acctbal, NULL, c_mktsegment FROM customer WHERE c_mktsegment = 'MACHINERY'
    """,
)
def explode_structs(t):
    name = lambda c: F.struct(c.alias("family"))
    comp = F.array(F.struct(F.struct(F.col("c_acctbal").alias("value")).alias("quantity")))
    rows = t.customer.select(
        "c_custkey",
        F.array(name(F.col("c_name")), name(F.lit("alias"))).alias("name"),
        comp.alias("component"),
        F.parse_json(F.to_json(F.struct(F.struct(F.array("c_mktsegment").alias("Value")).alias("00080060")))).alias("meta"),
    )
    named = X.explode_structs(rows, "name", ["c_custkey", "component", "meta"])
    return named.select(
        "c_custkey",
        "name.family",
        X.nth_component(F.col("component"), 0, "quantity.value").alias("systolic"),
        X.nth_component(F.col("component"), 2, "quantity.value").alias("third"),
        X.variant_path(F.col("meta"), "$['00080060'].Value[0]").alias("code"),
    ).where(F.col("code") == "MACHINERY")


@query("typed_from_json", "SELECT event_id, CAST(trunc(value) AS BIGINT) AS whole, CAST(ts AS DATE) AS day FROM events")
def typed_from_json(t):
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("whole", T.LongType()),
            T.StructField("day", T.DateType()),
        ]
    )
    raw = F.to_json(
        F.struct("event_id", F.col("value").cast("decimal(12,2)").cast("string").alias("whole"), F.date_format("ts", "MM/dd/yyyy").alias("day"))
    )
    return R.typed_from_json(t.events.select(raw.alias("raw")), "raw", schema)


