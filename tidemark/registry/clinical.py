"""Queries over clinical records, built as JSON out of customers and orders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import clinical as Cl
from tidemark.registry.base import query


def text(c):
    return F.lit(c) if isinstance(c, str) else c


def concept(code, display="d"):
    return F.struct(
        F.array(F.struct(F.lit("urn:sys").alias("system"), text(code).alias("code"), text(display).alias("display"))).alias("coding"),
        text(display).alias("text"),
    )


def patients(t):
    ext = F.array(
        F.struct(F.lit(Cl.UK_ETHNIC).alias("url"), concept(F.col("c_mktsegment")).alias("valueCodeableConcept"), F.lit(None).cast("boolean").alias("valueBoolean")),
        F.struct(F.lit(Cl.INTERPRETER).alias("url"), F.lit(None).cast("struct<coding:array<struct<system:string,code:string,display:string>>,text:string>").alias("valueCodeableConcept"), (F.col("c_acctbal") < 0).alias("valueBoolean")),
    )
    doc = F.struct(
        F.lit("Patient").alias("resourceType"),
        F.concat(F.lit("p"), "c_custkey").alias("id"),
        F.struct(F.lit("2024-01-02T03:04:05Z").alias("lastUpdated")).alias("meta"),
        F.array(
            F.struct(F.lit("urn:other").alias("system"), F.lit("x").alias("value")),
            F.struct(F.lit(Cl.NHS_NUMBER).alias("system"), F.col("c_custkey").cast("string").alias("value")),
        ).alias("identifier"),
        F.when(F.col("c_acctbal") >= 0, F.lit(True)).alias("active"),
        F.array(F.struct(F.col("c_name").alias("family"), F.array(F.lit("A"), F.col("c_mktsegment")).alias("given"))).alias("name"),
        F.lit("1980-05-06").alias("birthDate"),
        F.when(F.col("c_acctbal") < 0, F.lit("2020-02-03T04:05:06+01:00")).alias("deceasedDateTime"),
        ext.alias("extension"),
    )
    return t.customer.select(F.to_json(doc).alias("raw"))


@query(
    "clinical_patient",
    """
    SELECT 'p' || c_custkey AS id, 'Patient' AS "resourceType", TIMESTAMP '2024-01-02 03:04:05' AS "lastUpdated",
           CASE WHEN c_acctbal >= 0 THEN true END AS active, c_name AS family, 'A ' || c_mktsegment AS given, '1980-05-06' AS "birthDate",
           CASE WHEN c_acctbal < 0 THEN TIMESTAMP '2020-02-03 03:05:06' END AS deceased_datetime, CAST(0 AS INTEGER) AS n_telecom,
           CAST(c_custkey AS VARCHAR) AS nhs_number, c_mktsegment AS ethnic, c_acctbal < 0 AS interpreter_required, true AS no_residence
    FROM customer
    """,
)
def clinical_patient(t):
    p = Cl.clinical_extract(patients(t), "raw", "Patient")
    return p.select(
        "id", "resourceType", "lastUpdated", "active", F.col("name")[0]["family"].alias("family"),
        F.array_join(F.col("name")[0]["given"], " ").alias("given"), "birthDate", "deceased_datetime",
        F.size("telecom").alias("n_telecom"), "nhs_number", F.col("ethnic_category.coding")[0]["code"].alias("ethnic"),
        "interpreter_required", F.col("residential_status").isNull().alias("no_residence"),
    )


@query(
    "clinical_observation",
    """
    SELECT 'o' || event_id AS id, event_type AS code, CASE WHEN event_type <> 'view' THEN value END AS quantity,
           CASE WHEN event_type = 'view' THEN 'text' END AS value_string, CASE WHEN event_type = 'click' THEN user_id END AS value_integer,
           date_trunc('second', ts) AS effective_datetime, 'Patient/' || user_id AS subject, CAST(1.5 AS DOUBLE) AS low_value, value AS systolic, CAST(0 AS INTEGER) AS n_members
    FROM events
    """,
)
def clinical_observation(t):
    qty = lambda c: F.struct(c.alias("value"), F.lit("mm").alias("unit"))
    doc = F.struct(
        F.lit("Observation").alias("resourceType"),
        F.concat(F.lit("o"), "event_id").alias("id"),
        F.lit("final").alias("status"),
        concept(F.col("event_type")).alias("code"),
        F.struct(F.concat(F.lit("Patient/"), "user_id").alias("reference")).alias("subject"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("effectiveDateTime"),
        F.when(F.col("event_type") != "view", qty(F.col("value"))).alias("valueQuantity"),
        F.when(F.col("event_type") == "view", F.lit("text")).alias("valueString"),
        F.when(F.col("event_type") == "click", F.col("user_id")).alias("valueInteger"),
        F.array(F.struct(qty(F.lit(1.5)).alias("low"))).alias("referenceRange"),
        F.array(F.struct(concept("8480-6").alias("code"), qty(F.col("value")).alias("valueQuantity"))).alias("component"),
    )
    o = Cl.clinical_extract(t.events.select(F.to_json(doc).alias("raw")), "raw", "Observation")
    return o.select(
        "id", F.col("code.coding")[0]["code"].alias("code"), F.col("value_quantity.value").alias("quantity"), "value_string",
        "value_integer", "effective_datetime", F.col("subject.reference").alias("subject"),
        F.col("reference_range")[0]["low_value"].alias("low_value"),
        F.col("component")[0]["value_quantity"]["value"].alias("systolic"), F.size("has_member").alias("n_members"),
    )


@query(
    "clinical_encounter",
    """
    SELECT 'e' || o_orderkey AS id, o_orderstatus AS class_code, o_orderdate AS started, o_orderdate + INTERVAL 1 DAY AS ended,
           CAST(2 AS BIGINT) AS rank, 'Condition/' || o_custkey AS condition, 'emd' AS admit_source FROM orders
    """,
)
def clinical_encounter(t):
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    doc = F.struct(
        F.lit("Encounter").alias("resourceType"),
        F.concat(F.lit("e"), "o_orderkey").alias("id"),
        F.struct(F.col("o_orderstatus").alias("code")).alias("class"),
        F.struct(
            F.date_format("o_orderdate", iso).alias("start"),
            F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"), iso).alias("end"),
        ).alias("period"),
        F.array(
            F.struct(F.struct(F.concat(F.lit("Condition/"), "o_custkey").alias("reference")).alias("condition"), F.lit(2).alias("rank"))
        ).alias("diagnosis"),
        F.struct(concept("emd").alias("admitSource")).alias("hospitalization"),
    )
    e = Cl.clinical_extract(t.orders.select(F.to_json(doc).alias("raw")), "raw", "Encounter")
    return e.select(
        "id", F.col("class_coding.code").alias("class_code"), F.col("period.start").alias("started"),
        F.col("period.end").alias("ended"), F.col("diagnosis")[0]["rank"].alias("rank"),
        F.col("diagnosis")[0]["condition"]["reference"].alias("condition"),
        F.col("hospitalization.admit_source.coding")[0]["code"].alias("admit_source"),
    )


@query(
    "clinical_medication_request",
    """
    SELECT 'm' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS id, 'BID' AS timing_code, l_quantity AS dose_value, 'mg' AS dose_unit,
           l_extendedprice AS quantity_value, l_returnflag = 'R' AS substitution_allowed_boolean FROM lineitem
    """,
)
def clinical_medication_request(t):
    doc = F.struct(
        F.lit("MedicationRequest").alias("resourceType"),
        F.concat_ws("-", F.concat(F.lit("m"), "l_orderkey"), "l_linenumber", "l_partkey").alias("id"),
        F.array(
            F.struct(
                F.struct(concept("BID").alias("code")).alias("timing"),
                F.array(F.struct(F.struct(F.col("l_quantity").alias("value"), F.lit("mg").alias("unit")).alias("doseQuantity"))).alias("doseAndRate"),
            )
        ).alias("dosageInstruction"),
        F.struct(F.struct(F.col("l_extendedprice").alias("value")).alias("quantity")).alias("dispenseRequest"),
        F.struct((F.col("l_returnflag") == "R").alias("allowedBoolean")).alias("substitution"),
    )
    m = Cl.clinical_extract(t.lineitem.select(F.to_json(doc).alias("raw")), "raw", "MedicationRequest")
    dose = F.col("dosage_instruction")[0]
    return m.select(
        "id", dose["timing_code"].alias("timing_code"), dose["dose_value"].alias("dose_value"), dose["dose_unit"].alias("dose_unit"),
        F.col("dispense_request.quantity_value").alias("quantity_value"), "substitution_allowed_boolean",
    )


_TYPES = list(Cl.RESOURCES)


@query(
    "clinical_all_types",
    " UNION ALL ".join(
        f"SELECT '{r}' AS resource_type, count(*) AS resources, count(*) FILTER (c_acctbal >= 0) AS with_status, "
        f"CAST({len(Cl.RESOURCES[r]) + 5 + (6 if r == 'Patient' else 0)} AS INTEGER) AS n_columns FROM customer"
        for r in _TYPES
    ),
)
def clinical_all_types(t):
    """Every resource type over all customers: rows, filled identifiers and column count."""

    def one(resource: str) -> DataFrame:
        ident = F.array(F.struct(F.col("c_name").alias("value")))
        doc = F.struct(
            F.lit(resource).alias("resourceType"),
            F.col("c_custkey").cast("string").alias("id"),
            F.when(F.col("c_acctbal") >= 0, ident).alias("identifier"),
            F.when(F.col("c_acctbal") >= 0, F.lit("final")).alias("status"),
        )
        got = Cl.clinical_extract(t.customer.select(F.to_json(doc).alias("raw")), "raw", resource)
        filled = F.size("identifier") > 0 if "identifier" in got.columns else F.col("status").isNotNull()
        return got.agg(
            F.lit(resource).alias("resource_type"),
            F.count("id").alias("resources"),
            F.count_if(filled).alias("with_status"),
            F.lit(len(got.columns)).alias("n_columns"),
        )

    return reduce(DataFrame.unionByName, [one(r) for r in _TYPES])


@query("clinical_data_types", "SELECT c_custkey, c_mktsegment AS code, c_name AS display, TIMESTAMP '2024-01-01' AS started, c_acctbal AS amount FROM customer")
def clinical_data_types(t):
    """Single data types out of JSON text."""
    cc = Cl.typed_element(F.to_json(concept(F.col("c_mktsegment"), F.col("c_name"))), Cl.CONCEPT)
    period = Cl.typed_element(F.lit('{"start":"2024-01-01"}'), Cl.PERIOD)
    qty = Cl.typed_element(F.to_json(F.struct(F.col("c_acctbal").alias("value"))), Cl.QUANTITY)
    return t.customer.select(
        "c_custkey", cc["coding"][0]["code"].alias("code"), cc["text"].alias("display"),
        period["start"].alias("started"), qty["value"].alias("amount"),
    )


def _two(first, second):
    return F.array(first, second)


def _both(first, second):
    """Two objects whose fields may differ."""
    return F.array(F.parse_json(F.to_json(first)), F.parse_json(F.to_json(second)))


def _ref(prefix, c):
    return F.struct(F.concat(F.lit(prefix), c).alias("reference"))


def _value_docs():
    """Per type: its fields, and the checked values of the result."""
    key, name, seg = F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_mktsegment")
    code = lambda c: concept(c)
    coded = lambda c: c["coding"][0]["code"]
    notes = _two(F.struct(name.alias("text")), F.struct(F.lit("two").alias("text")))
    day, when = F.lit("2024-01-02"), F.lit("2024-01-02T03:04:05Z")
    as_time = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    col = F.col
    return {
        "Condition": (
            {"clinicalStatus": code(seg), "onsetDateTime": when, "note": notes, "bodySite": _two(code(F.lit("left")), code(seg))},
            {"clinical": coded(col("clinical_status")), "onset": as_time("onset_datetime"),
             "second note": col("note")[1]["text"], "second site": coded(col("body_site")[1])},
        ),
        "AllergyIntolerance": (
            {"type": seg, "category": _two(F.lit("food"), seg), "criticality": F.lit("low"),
             "reaction": _both(F.struct(F.lit("first").alias("description")), F.struct(name.alias("description"), _two(code(seg), code(F.lit("m2"))).alias("manifestation")))},
            {"type": col("type"), "second category": col("category")[1],
             "second reaction": col("reaction")[1]["description"], "second sign": coded(col("reaction")[1]["manifestation"][1])},
        ),
        "Procedure": (
            {"status": seg, "performedDateTime": when, "performer": _two(F.struct(_ref("a/", key).alias("actor")), F.struct(_ref("b/", key).alias("actor"))), "note": notes},
            {"status": col("status"), "performed": as_time("performed_datetime"),
             "second actor": col("performer")[1]["actor"]["reference"], "notes": F.size("note").cast("string")},
        ),
        "DiagnosticReport": (
            {"status": seg, "issued": when, "result": _two(_ref("r/", key), _ref("s/", key)), "conclusion": name},
            {"status": col("status"), "issued": as_time("issued"),
             "second result": col("result")[1]["reference"], "conclusion": col("conclusion")},
        ),
        "Immunization": (
            {"vaccineCode": code(seg), "occurrenceDateTime": when, "primarySource": F.col("c_acctbal") >= 0, "lotNumber": name,
             "protocolApplied": _both(F.struct(F.lit("x").alias("series"), F.lit(1).alias("doseNumberPositiveInt")), F.struct(seg.alias("series"), F.col("c_nationkey").alias("doseNumberPositiveInt")))},
            {"vaccine": coded(col("vaccine_code")), "occurred": as_time("occurrence_datetime"),
             "primary": col("primary_source").cast("string"), "lot": col("lot_number"),
             "second dose": col("protocol_applied")[1]["dose_number_positive_int"].cast("string")},
        ),
        "Coverage": (
            {"status": seg, "subscriberId": key, "payor": _two(_ref("p/", key), _ref("q/", key)), "order": F.col("c_nationkey"),
             "class": _both(F.struct(F.lit("a").alias("value")), F.struct(name.alias("value")))},
            {"subscriber": col("subscriber_id"), "second payor": col("payor")[1]["reference"],
             "order": col("order").cast("string"), "second class": col("class_coverage")[1]["value"]},
        ),
        "CarePlan": (
            {"title": name, "intent": seg, "goal": _two(_ref("g/", key), _ref("h/", key)),
             "activity": _both(F.struct(F.struct(F.lit("a").alias("status")).alias("detail")), F.struct(F.struct(seg.alias("status"), name.alias("description")).alias("detail")))},
            {"title": col("title"), "second goal": col("goal")[1]["reference"],
             "second status": col("activity")[1]["detail_status"], "second text": col("activity")[1]["detail_description"]},
        ),
        "Goal": (
            {"lifecycleStatus": seg, "description": code(seg), "startDate": day,
             "target": _both(F.struct(F.lit("2024-01-01").alias("dueDate")), F.struct(F.lit("2024-02-01").alias("dueDate"), F.struct(F.col("c_acctbal").alias("value")).alias("detailQuantity")))},
            {"lifecycle": col("lifecycle_status"), "start": col("start_date"),
             "second due": col("target")[1]["due_date"],
             "second amount": F.round(col("target")[1]["detail_quantity"]["value"] * 100).cast("bigint").cast("string")},
        ),
        "Device": (
            {"manufacturer": name, "serialNumber": key, "deviceName": _both(F.struct(F.lit("n").alias("name")), F.struct(seg.alias("name"), F.lit("t").alias("type")))},
            {"manufacturer": col("manufacturer"), "serial": col("serial_number"),
             "second name": col("device_name")[1]["name"], "second kind": col("device_name")[1]["type"]},
        ),
        "DocumentReference": (
            {"docStatus": seg, "date": when, "author": _two(_ref("a/", key), _ref("b/", key)),
             "content": _both(F.struct(F.struct(F.lit("u").alias("url")).alias("attachment")), F.struct(F.struct(name.alias("url"), F.lit("t/p").alias("contentType")).alias("attachment")))},
            {"state": col("doc_status"), "date": as_time("date"),
             "second author": col("author")[1]["reference"], "second url": col("content")[1]["attachment_url"],
             "second type": col("content")[1]["attachment_content_type"]},
        ),
    }


# what the SQL expects, field by field
_VALUE_SQL = {
    "Condition": {"clinical": "c_mktsegment", "onset": "'2024-01-02 03:04:05'", "second note": "'two'", "second site": "c_mktsegment"},
    "AllergyIntolerance": {"type": "c_mktsegment", "second category": "c_mktsegment", "second reaction": "c_name", "second sign": "'m2'"},
    "Procedure": {"status": "c_mktsegment", "performed": "'2024-01-02 03:04:05'", "second actor": "'b/' || c_custkey", "notes": "'2'"},
    "DiagnosticReport": {"status": "c_mktsegment", "issued": "'2024-01-02 03:04:05'", "second result": "'s/' || c_custkey", "conclusion": "c_name"},
    "Immunization": {
        "vaccine": "c_mktsegment", "occurred": "'2024-01-02 03:04:05'", "primary": "(c_acctbal >= 0)::VARCHAR", "lot": "c_name",
        "second dose": "c_nationkey::VARCHAR",
    },
    "Coverage": {"subscriber": "c_custkey::VARCHAR", "second payor": "'q/' || c_custkey", "order": "c_nationkey::VARCHAR", "second class": "c_name"},
    "CarePlan": {"title": "c_name", "second goal": "'h/' || c_custkey", "second status": "c_mktsegment", "second text": "c_name"},
    "Goal": {
        "lifecycle": "c_mktsegment", "start": "'2024-01-02'", "second due": "'2024-02-01'", "second amount": "round(c_acctbal * 100)::BIGINT::VARCHAR",
    },
    "Device": {"manufacturer": "c_name", "serial": "c_custkey::VARCHAR", "second name": "c_mktsegment", "second kind": "'t'"},
    "DocumentReference": {
        "state": "c_mktsegment", "date": "'2024-01-02 03:04:05'", "second author": "'b/' || c_custkey", "second url": "c_name", "second type": "'t/p'",
    },
}


@query(
    "clinical_values",
    " UNION ALL ".join(
        f"SELECT '{resource}' AS resource, c_custkey::VARCHAR AS id, '{field}' AS field, {sql} AS value FROM customer"
        for resource, fields in _VALUE_SQL.items()
        for field, sql in fields.items()
    ),
)
def clinical_values(t):
    """Values of ten resource types, among them the second child of each array."""

    def one(resource: str, fields: dict, values: dict) -> DataFrame:
        doc = F.struct(
            F.lit(resource).alias("resourceType"), F.col("c_custkey").cast("string").alias("id"), *[c.alias(k) for k, c in fields.items()]
        )
        got = Cl.clinical_extract(t.customer.select(F.to_json(doc).alias("raw")), "raw", resource)
        pairs = F.array(*[F.struct(F.lit(k).alias("field"), c.alias("value")) for k, c in values.items()])
        return got.select(F.lit(resource).alias("resource"), "id", F.explode(pairs).alias("p")).select("resource", "id", "p.field", "p.value")

    return reduce(DataFrame.unionByName, [one(r, fields, values) for r, (fields, values) in _value_docs().items()])
