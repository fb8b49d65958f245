"""Typed columns out of clinical resources (HL7 FHIR R4).

A resource type is described by its columns; from the description follow the
JSON schema to read it with and the native expressions that project it.  Each
form of a polymorphic value keeps its own column.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import parse_ts_any

TEXT, FLAG, LONG, REAL, TIME = "text", "flag", "long", "real", "time"


@dataclass(frozen=True)
class At:
    """A column taken from another element path than its name says."""

    path: str
    kind: Any


# The parts of the FHIR data types that are kept.
CODING = {"system": TEXT, "code": TEXT, "display": TEXT}
CONCEPT = {"coding": [CODING], "text": TEXT}
REFERENCE = {"reference": TEXT, "display": TEXT}
PERIOD = {"start": TIME, "end": TIME}
IDENTIFIER = {"system": TEXT, "value": TEXT, "use": TEXT}
HUMAN_NAME = {"family": TEXT, "given": [TEXT], "text": TEXT, "use": TEXT}
ADDRESS = {
    "use": TEXT, "line": [TEXT], "city": TEXT, "district": TEXT, "postalCode": TEXT, "country": TEXT,
}
CONTACT = {"system": TEXT, "value": TEXT, "use": TEXT}
QUANTITY = {"value": REAL, "unit": TEXT, "system": TEXT, "code": TEXT}
NOTE = {"text": TEXT, "time": TIME}
DOSAGE = {
    "text": TEXT,
    "timing_code": At("timing.code.coding[0].code", TEXT),
    "dose_value": At("doseAndRate[0].doseQuantity.value", REAL),
    "dose_unit": At("doseAndRate[0].doseQuantity.unit", TEXT),
    "route": CONCEPT,
    "site": CONCEPT,
}

# Columns per resource type.
RESOURCES: dict[str, dict[str, Any]] = {
    "Patient": {
        "identifier": [IDENTIFIER], "active": FLAG, "name": [HUMAN_NAME], "telecom": [CONTACT], "gender": TEXT,
        "birthDate": TEXT, "deceased_boolean": FLAG, "deceased_datetime": TIME, "address": [ADDRESS],
        "maritalStatus": CONCEPT, "generalPractitioner": [REFERENCE], "managingOrganization": REFERENCE,
    },
    "Observation": {
        "status": TEXT, "category": [CONCEPT], "code": CONCEPT, "subject": REFERENCE, "encounter": REFERENCE,
        "effective_datetime": TIME, "effective_period": PERIOD, "issued": TIME, "performer": [REFERENCE],
        "value_quantity": QUANTITY, "value_codeable_concept": CONCEPT, "value_string": TEXT, "value_boolean": FLAG,
        "value_integer": LONG, "data_absent_reason": CONCEPT, "interpretation": [CONCEPT], "body_site": CONCEPT,
        "method": CONCEPT, "specimen": REFERENCE, "device": REFERENCE,
        "reference_range": [
            {
                "low_value": At("low.value", REAL), "low_unit": At("low.unit", TEXT),
                "high_value": At("high.value", REAL), "high_unit": At("high.unit", TEXT),
                "type": CONCEPT, "text": TEXT,
            }
        ],
        "has_member": [REFERENCE], "derived_from": [REFERENCE],
        "component": [
            {
                "code": CONCEPT, "value_quantity": QUANTITY, "value_string": TEXT, "value_codeable_concept": CONCEPT,
                "value_boolean": FLAG, "value_integer": LONG, "data_absent_reason": CONCEPT,
            }
        ],
    },
    "Condition": {
        "identifier": [IDENTIFIER], "clinical_status": CONCEPT, "verification_status": CONCEPT, "category": [CONCEPT],
        "severity": CONCEPT, "code": CONCEPT, "body_site": [CONCEPT], "subject": REFERENCE, "encounter": REFERENCE,
        "onset_datetime": TIME, "onset_period": PERIOD, "onset_string": TEXT, "abatement_datetime": TIME,
        "abatement_string": TEXT, "recorded_date": TEXT, "recorder": REFERENCE, "asserter": REFERENCE, "note": [NOTE],
    },
    "AllergyIntolerance": {
        "identifier": [IDENTIFIER], "clinical_status": CONCEPT, "verification_status": CONCEPT, "type": TEXT,
        "category": [TEXT], "criticality": TEXT, "code": CONCEPT, "patient": REFERENCE, "encounter": REFERENCE,
        "onset_datetime": TIME, "onset_string": TEXT, "recorded_date": TEXT, "recorder": REFERENCE,
        "asserter": REFERENCE, "last_occurrence": TIME, "note": [NOTE],
        "reaction": [
            {
                "substance": CONCEPT, "manifestation": [CONCEPT], "description": TEXT, "onset": TIME,
                "severity": TEXT, "exposure_route": CONCEPT,
            }
        ],
    },
    "Encounter": {
        "identifier": [IDENTIFIER], "status": TEXT, "class_coding": At("class", CODING), "type": [CONCEPT],
        "service_type": CONCEPT, "priority": CONCEPT, "subject": REFERENCE, "episode_of_care": [REFERENCE],
        "participant": [{"type": [CONCEPT], "period": PERIOD, "individual": REFERENCE}],
        "appointment": [REFERENCE], "period": PERIOD, "reason_code": [CONCEPT], "reason_reference": [REFERENCE],
        "diagnosis": [{"condition": REFERENCE, "use": CONCEPT, "rank": LONG}],
        "hospitalization": {
            "admit_source": CONCEPT, "re_admission": CONCEPT, "discharge_disposition": CONCEPT,
            "origin": REFERENCE, "destination": REFERENCE,
        },
        "location": [{"location": REFERENCE, "status": TEXT, "physical_type": CONCEPT, "period": PERIOD}],
        "service_provider": REFERENCE, "part_of": REFERENCE,
    },
    "Procedure": {
        "identifier": [IDENTIFIER], "status": TEXT, "status_reason": CONCEPT, "category": CONCEPT, "code": CONCEPT,
        "subject": REFERENCE, "encounter": REFERENCE, "performed_datetime": TIME, "performed_period": PERIOD,
        "recorder": REFERENCE, "asserter": REFERENCE,
        "performer": [{"function": CONCEPT, "actor": REFERENCE, "on_behalf_of": REFERENCE}],
        "location": REFERENCE, "reason_code": [CONCEPT], "reason_reference": [REFERENCE], "body_site": [CONCEPT],
        "outcome": CONCEPT, "report": [REFERENCE], "complication": [CONCEPT], "follow_up": [CONCEPT], "note": [NOTE],
    },
    "DiagnosticReport": {
        "identifier": [IDENTIFIER], "based_on": [REFERENCE], "status": TEXT, "category": [CONCEPT], "code": CONCEPT,
        "subject": REFERENCE, "encounter": REFERENCE, "effective_datetime": TIME, "effective_period": PERIOD,
        "issued": TIME, "performer": [REFERENCE], "results_interpreter": [REFERENCE], "specimen": [REFERENCE],
        "result": [REFERENCE], "conclusion": TEXT, "conclusion_code": [CONCEPT],
    },
    "MedicationRequest": {
        "identifier": [IDENTIFIER], "status": TEXT, "status_reason": CONCEPT, "intent": TEXT, "category": [CONCEPT],
        "priority": TEXT, "medication_codeable_concept": CONCEPT, "medication_reference": REFERENCE,
        "subject": REFERENCE, "encounter": REFERENCE, "authored_on": TEXT, "requester": REFERENCE,
        "reason_code": [CONCEPT], "reason_reference": [REFERENCE], "note": [NOTE], "dosage_instruction": [DOSAGE],
        "dispense_request": {
            "validity_period": PERIOD, "number_of_repeats_allowed": LONG,
            "quantity_value": At("quantity.value", REAL), "quantity_unit": At("quantity.unit", TEXT),
            "expected_supply_duration_value": At("expectedSupplyDuration.value", REAL),
            "expected_supply_duration_unit": At("expectedSupplyDuration.unit", TEXT),
        },
        "substitution_allowed_boolean": At("substitution.allowedBoolean", FLAG),
    },
    "Immunization": {
        "identifier": [IDENTIFIER], "status": TEXT, "status_reason": CONCEPT, "vaccine_code": CONCEPT,
        "patient": REFERENCE, "encounter": REFERENCE, "occurrence_datetime": TIME, "occurrence_string": TEXT,
        "recorded": TEXT, "primary_source": FLAG, "manufacturer": REFERENCE, "lot_number": TEXT,
        "expiration_date": TEXT, "site": CONCEPT, "route": CONCEPT, "dose_quantity": QUANTITY,
        "performer": [{"function": CONCEPT, "actor": REFERENCE}], "reason_code": [CONCEPT],
        "reason_reference": [REFERENCE], "is_subpotent": FLAG, "program_eligibility": [CONCEPT],
        "funding_source": CONCEPT,
        "protocol_applied": [
            {
                "series": TEXT, "authority": REFERENCE, "target_disease": [CONCEPT], "dose_number_positive_int": LONG,
                "dose_number_string": TEXT, "series_doses_positive_int": LONG, "series_doses_string": TEXT,
            }
        ],
    },
    "Coverage": {
        "identifier": [IDENTIFIER], "status": TEXT, "type": CONCEPT, "policy_holder": REFERENCE,
        "subscriber": REFERENCE, "subscriber_id": TEXT, "beneficiary": REFERENCE, "dependent": TEXT,
        "relationship": CONCEPT, "period": PERIOD, "payor": [REFERENCE],
        "class_coverage": At("class", [{"type": CONCEPT, "value": TEXT, "name": TEXT}]),
        "order": LONG, "network": TEXT, "subrogation": FLAG,
    },
    "CarePlan": {
        "identifier": [IDENTIFIER], "status": TEXT, "intent": TEXT, "category": [CONCEPT], "title": TEXT,
        "description": TEXT, "subject": REFERENCE, "encounter": REFERENCE, "period": PERIOD, "created": TEXT,
        "author": REFERENCE, "care_team": [REFERENCE], "addresses": [REFERENCE], "goal": [REFERENCE],
        "activity": [
            {
                "reference": REFERENCE, "detail_status": At("detail.status", TEXT),
                "detail_code": At("detail.code", CONCEPT), "detail_description": At("detail.description", TEXT),
            }
        ],
        "note": [NOTE],
    },
    "Goal": {
        "identifier": [IDENTIFIER], "lifecycle_status": TEXT, "achievement_status": CONCEPT, "category": [CONCEPT],
        "priority": CONCEPT, "description": CONCEPT, "subject": REFERENCE, "start_date": TEXT,
        "start_codeable_concept": CONCEPT,
        "target": [
            {
                "measure": CONCEPT, "detail_quantity": QUANTITY, "detail_string": TEXT, "detail_boolean": FLAG,
                "due_date": TEXT,
            }
        ],
        "status_date": TEXT, "status_reason": TEXT, "expressed_by": REFERENCE, "addresses": [REFERENCE], "note": [NOTE],
    },
    "Device": {
        "identifier": [IDENTIFIER], "status": TEXT, "status_reason": [CONCEPT], "manufacturer": TEXT,
        "manufacture_date": TEXT, "expiration_date": TEXT, "lot_number": TEXT, "serial_number": TEXT,
        "device_name": [{"name": TEXT, "type": TEXT}], "model_number": TEXT, "type": CONCEPT, "patient": REFERENCE,
        "owner": REFERENCE, "contact": [CONTACT], "note": [NOTE], "safety": [CONCEPT],
    },
    "DocumentReference": {
        "identifier": [IDENTIFIER], "status": TEXT, "doc_status": TEXT, "type": CONCEPT, "category": [CONCEPT],
        "subject": REFERENCE, "date": TIME, "author": [REFERENCE], "authenticator": REFERENCE, "custodian": REFERENCE,
        "relates_to": [{"code": TEXT, "target": REFERENCE}], "description": TEXT, "security_label": [CONCEPT],
        "content": [
            {
                "attachment_url": At("attachment.url", TEXT), "attachment_title": At("attachment.title", TEXT),
                "attachment_content_type": At("attachment.contentType", TEXT),
                "format_code": At("format.code", TEXT), "format_system": At("format.system", TEXT),
            }
        ],
        "context": {
            "encounter": [REFERENCE], "event": [CONCEPT], "period": PERIOD, "facility_type": CONCEPT,
            "practice_setting": CONCEPT,
        },
    },
}

# Addresses of the UK patient extensions and the NHS number system.
UK = "https://fhir.hl7.org.uk/StructureDefinition/Extension-UKCore-"
UK_ETHNIC = f"{UK}EthnicCategory"
UK_BIRTH_SEX = f"{UK}BirthSex"
UK_DEATH = f"{UK}DeathNotificationStatus"
UK_RESIDENTIAL = f"{UK}ResidentialStatus"
INTERPRETER = "http://hl7.org/fhir/StructureDefinition/patient-interpreterRequired"
NHS_NUMBER = "https://fhir.nhs.uk/Id/nhs-number"


def element_name(column: str) -> str:
    """``effective_datetime`` -> ``effectiveDateTime``."""
    name = re.sub(r"_([a-z])", lambda m: m.group(1).upper(), column)
    return name.replace("Datetime", "DateTime")


def _resolve(column: str, kind: Any) -> tuple[list[str], Any]:
    if isinstance(kind, At):
        return kind.path.split("."), kind.kind
    return [element_name(column)], kind


def _tree(shape: dict[str, Any]) -> dict[str, Any]:
    """Elements to read, as nested dicts (``[x]`` marks a list)."""
    root: dict[str, Any] = {}
    for column, kind in shape.items():
        path, kind = _resolve(column, kind)
        at = root
        for step in path[:-1]:
            listed = step.endswith("[0]")
            name = step[:-3] if listed else step
            child = at.setdefault(name, [{}] if listed else {})
            at = child[0] if listed else child
        at[path[-1]] = _read(kind)
    return root


def _read(kind: Any) -> Any:
    if isinstance(kind, list):
        return [_read(kind[0])]
    return _tree(kind) if isinstance(kind, dict) else "string"


def _ddl(node: Any) -> str:
    if isinstance(node, list):
        return f"array<{_ddl(node[0])}>"
    if isinstance(node, dict):
        return "struct<" + ",".join(f"`{k}`:{_ddl(v)}" for k, v in node.items()) + ">"
    return node


def _at(c: Column, path: list[str]) -> Column:
    for step in path:
        c = F.get(c[step[:-3]], F.lit(0)) if step.endswith("[0]") else c[step]
    return c


def _as_read(kind: Any) -> bool:
    """Whether a type is read in its final form: text, or an object of texts under their own names."""
    if isinstance(kind, dict):
        return all(sub == TEXT and element_name(column) == column for column, sub in kind.items())
    return kind == TEXT


def extract(c: Column, kind: Any) -> Column:
    """One element by its description; a missing list is empty, a missing object null."""
    if isinstance(kind, list):
        items = F.filter(c, lambda x: x.isNotNull())
        if not _as_read(kind[0]):
            items = F.transform(items, lambda x: extract(x, kind[0]))
        return F.coalesce(items, F.array().cast(f"array<{_out_ddl(kind[0])}>"))
    if _as_read(kind):
        return c
    if isinstance(kind, dict):
        fields = []
        for column, sub in kind.items():
            path, sub = _resolve(column, sub)
            fields.append(extract(_at(c, path), sub).alias(column))
        return F.when(c.isNotNull(), F.struct(*fields))
    if kind == FLAG:
        return c.try_cast("boolean")
    if kind == LONG:
        return c.try_cast("bigint")
    if kind == REAL:
        return c.try_cast("double")
    return parse_ts_any(c)


_OUT = {TEXT: "string", FLAG: "boolean", LONG: "bigint", REAL: "double", TIME: "timestamp"}


def _out_ddl(kind: Any) -> str:
    if isinstance(kind, At):
        return _out_ddl(kind.kind)
    if isinstance(kind, list):
        return f"array<{_out_ddl(kind[0])}>"
    if isinstance(kind, dict):
        return "struct<" + ",".join(f"`{k}`:{_out_ddl(v)}" for k, v in kind.items()) + ">"
    return _OUT[kind]


def typed_element(c: Column, kind: Any) -> Column:
    """JSON text of one data type (coding, concept, period, dosage and so on) as typed value."""
    return extract(F.from_json(c, _ddl(_read(kind))), kind)


EXTENSION = (
    "array<struct<url:string,valueBoolean:string,valueCodeableConcept:struct<coding:array<struct<system:string,"
    "code:string,display:string>>,text:string>,extension:array<struct<url:string,"
    "valueCodeableConcept:struct<coding:array<struct<system:string,code:string,display:string>>,text:string>>>>>"
)


def _first(items: Column, key: str, value: str) -> Column:
    return F.get(F.filter(items, lambda x: x[key] == value), F.lit(0))


def _uk_patient(record: Column, columns: dict[str, Column]) -> dict[str, Column]:
    ext = F.from_json(record["extension"], EXTENSION)
    concept = lambda url: extract(_first(ext, "url", url)["valueCodeableConcept"], CONCEPT)
    death = _first(_first(ext, "url", UK_DEATH)["extension"], "url", "deathNotificationStatus")
    return {
        **columns,
        "nhs_number": _first(columns["identifier"], "system", NHS_NUMBER)["value"],
        "ethnic_category": concept(UK_ETHNIC),
        "birth_sex": concept(UK_BIRTH_SEX),
        "death_notification_status": extract(death["valueCodeableConcept"], CONCEPT),
        "interpreter_required": _first(ext, "url", INTERPRETER)["valueBoolean"].try_cast("boolean"),
        "residential_status": concept(UK_RESIDENTIAL),
    }


# Profiles from the most specific; each adds to what the base description gives.
PROFILES = ("uk_core", "base_r4")
OVERRIDES: dict[tuple[str, str], Callable[[Column, dict[str, Column]], dict[str, Column]]] = {
    ("Patient", "uk_core"): _uk_patient
}


def register_profile(resource: str, profile: str, build: Callable[[Column, dict[str, Column]], dict[str, Column]]) -> None:
    """Add columns of a profile for one resource type: ``build(record, base columns) -> columns``."""
    OVERRIDES[(resource, profile)] = build


def profile_chain(profile: str) -> list[str]:
    return list(PROFILES[PROFILES.index(profile) :]) if profile in PROFILES else [profile, *PROFILES]


def clinical_extract(df: DataFrame, raw: str, resource: str, profile: str = "uk_core") -> DataFrame:
    """Common fields, then the typed columns of the first profile that knows the type.

    A type nobody knows keeps only the common fields.
    """
    c, shape = F.col(raw), RESOURCES.get(resource, {})
    read = {"id": "string", "resourceType": "string", "meta": {"lastUpdated": "string"}, "extension": "string", **_read(shape)}
    record = F.col("_record")
    out: dict[str, Column] = {
        "id": record["id"],
        "resourceType": F.coalesce(record["resourceType"], F.lit(resource)),
        "lastUpdated": parse_ts_any(record["meta"]["lastUpdated"]),
        "raw_json": c,
        "extension": record["extension"],
    }
    typed = {}
    for column, kind in shape.items():
        path, kind = _resolve(column, kind)
        typed[column] = extract(_at(record, path), kind)
    for name in profile_chain(profile):
        if (resource, name) in OVERRIDES:
            typed = OVERRIDES[(resource, name)](record, typed)
            break
        if name == "base_r4":
            break
    out.update(typed)
    keep = [k for k in df.columns if k != raw]
    rows = df.withColumn("_record", F.from_json(c, _ddl(read)))
    return rows.select(*keep, *[v.alias(k) for k, v in out.items()])
