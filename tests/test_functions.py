"""Scalar functions, typed projection and reshaping on edge cases."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import clinical as Cl
from tidemark.functions import coercion as C
from tidemark.functions import scalars as S
from tidemark.operators import filters as Fl
from tidemark.operators import paging as P
from tidemark.operators import reshape as R
from tidemark.operators import scan as Sc
from tidemark.operators import synth as Sy
from tidemark.plans import ingest as In
from tidemark.plans import report as Rp


def one(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r["o"] for r in df.select("i", fn(F.col("c")).alias("o")).orderBy("i").collect()]


def test_scalars(spark):
    assert one(spark, S.odata_date, ["/Date(1234567890000)/", "/Date(-1000+0100)/", "2024", None]) == [
        "2009-02-13T23:31:30Z", "1969-12-31T23:59:59Z", "2024", None,
    ]
    assert one(spark, S.yyyymmdd, ["20240131", "20231315", "2024", None]) == ["2024-01-31", None, None, None]
    assert one(spark, S.parse_ts_any, ["2024-01-01T00:00:00.123Z", "2024-01-01", "2024-01-01T02:00:00+02:00", "x", ""]) == [
        datetime(2024, 1, 1, 0, 0, 0, 123000), datetime(2024, 1, 1), datetime(2024, 1, 1), None, None,
    ]
    now = F.lit("2024-03-08").cast("timestamp")
    assert one(spark, lambda c: S.relative_time(c, now), ["*", "*-7d", "*-2h", "*-10x", None, "2024-01-01"]) == [
        datetime(2024, 3, 8), datetime(2024, 3, 1), datetime(2024, 3, 7, 22), datetime(2024, 3, 8), datetime(2024, 3, 8), datetime(2024, 1, 1),
    ]
    assert one(spark, lambda c: S.as_bool(c, True), ["No", " y ", "?", None]) == [False, True, True, True]
    assert one(spark, S.try_long, ["7", " 8 ", "3.7", "x", ""]) == [7, 8, None, None, None]
    assert one(spark, S.decode_binary, ["aGVsbG8=", "48656c6c6f", "hello", "", None]) == [b"hello", b"Hello", b"hello", b"", None]
    assert one(spark, S.csv_list, [" a, ,b ,", "", None]) == [["a", "b"], [], None]
    assert one(spark, S.text_list, ['["a","b"]', "a", "[bad", None]) == [["a", "b"], ["a"], ["[bad"], None]
    assert one(spark, S.snake_case, ["recordedDate", "QIDText", "userID2Name"]) == ["recorded_date", "qid_text", "user_id2_name"]
    assert one(spark, lambda c: S.sanitize_name(c, F.lit(3)), [" A b!", "__", "x--y_"]) == ["A_b", "_col3", "x_y"]
    assert one(spark, S.valid_uid, ["1.2.3", "1..2", "1.a", ""]) == [True, False, False, False]
    assert one(spark, S.redact_email, ["mail a.b@c-d.org now", "a@b"]) == ["mail redacted@example.com now", "a@b"]
    assert one(spark, C.to_boolean, ["T", "n", "maybe", "", None]) == [True, False, True, False, None]
    assert one(spark, C.to_date, ["2024-1-5", "03/04/2024", "04-03-2024", "2024/3/4", "2024-03-04T10:00:00Z", "2024-13-01", "x"]) == [
        date(2024, 1, 5), date(2024, 3, 4), date(2024, 3, 4), date(2024, 3, 4), date(2024, 3, 4), None, None,
    ]
    assert one(spark, C.to_timestamp, ["2024/03/04 05:06:07", "2024-03-04 05:06:07", "04.03.2024"]) == [
        datetime(2024, 3, 4, 5, 6, 7), datetime(2024, 3, 4, 5, 6, 7), None,
    ]


def test_fingerprint_keeps_null_and_empty_apart(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), (None, "a")], "x string, y string")
    assert df.select(S.record_fingerprint(F.col("x"), F.col("y")).alias("h")).distinct().count() == 3


NESTED = T.StructType(
    [
        T.StructField("s", T.StructType([T.StructField("x", T.LongType(), False), T.StructField("y", T.ArrayType(T.DoubleType()))])),
        T.StructField("m", T.MapType(T.StringType(), T.LongType())),
        T.StructField("d", T.DecimalType(10, 2)),
        T.StructField("v", T.VariantType()),
        T.StructField("new", T.StringType()),
    ]
)


def test_coerce_nested(spark):
    raw = spark.createDataFrame(
        [
            ('{"x":"3.7","y":[1,"2.5"]}', '{"a":"1"}', "1.239", '{"z":1}'),
            ('{"x":1,"y":5}', "{}", "abc", None),  # a scalar in place of a list
            ('{"y":[1]}', None, None, None),  # required field missing
            ("{}", None, None, None),
        ],
        "s string, m string, d string, v string",
    )
    got = C.coerce(raw, NESTED).select("s", "m", F.col("d").cast("string").alias("d"), C.ERRORS).collect()
    assert [r["s"] and (r["s"]["x"], r["s"]["y"]) for r in got] == [(3, [1.0, 2.5]), (1, [5.0]), None, None]
    assert got[0]["m"] == {"a": 1} and got[0]["d"] == "1.24"
    assert [r[C.ERRORS] for r in got] == [[], ["d"], ["s"], ["s"]]
    with pytest.raises(Exception, match="does not fit"):
        C.coerce(raw, NESTED, "strict").collect()


def test_decimal_bounds():
    assert C.decimal_of(60, 50) == T.DecimalType(38, 38)
    assert C.decimal_of(None, None) == T.DecimalType(38, 18)


def test_files(spark, tmp_path):
    (tmp_path / "r.csv").write_text('﻿Event Time,Event Name,Device ID\n2024-01-01,"a, b",\n', encoding="utf-8")
    report = Sc.read_csv_report(spark, str(tmp_path / "r.csv"))
    assert report.columns == ["event_time", "event_name", "device_id"]
    assert [tuple(r) for r in report.collect()] == [("2024-01-01", "a, b", None)]
    (tmp_path / "h.csv").write_text("A,B\n")
    assert Sc.read_csv_report(spark, str(tmp_path / "h.csv")).count() == 0
    (tmp_path / "l.jsonl").write_text('{"a": 1}\n\n{"a": \n{"a": 2}\n')
    good, bad = Sc.read_jsonl(spark, str(tmp_path / "l.jsonl"), "a long")
    assert sorted(r["a"] for r in good.collect()) == [1, 2]
    assert bad.first()["bad_lines"] == 1


def test_envelopes(spark):
    bodies = [
        '{"items":[{"a":1},{"a":2}],"offset":0}',
        '[{"a":3},7]',
        '{"odd":[{"a":4}],"more":[{"a":5},{"a":6}],"words":["x","y","z"]}',
        '{"data":[]}',
        "broken",
    ]
    df = spark.createDataFrame([(b,) for b in bodies], "raw string")
    got = Sc.unwrap_records(df).select(F.try_variant_get("record", "$.a", "int").alias("a")).collect()
    assert sorted(r["a"] for r in got) == [1, 2, 3, 5, 6]
    named = Sc.unwrap_records(df, key="odd").select(F.try_variant_get("record", "$.a", "int").alias("a")).collect()
    assert sorted(r["a"] for r in named) == [1, 2, 3, 4]  # bare arrays and known keys count beside the named one


def test_sheet_headers():
    assert R.sanitized_names(["Name", " ", "Unit Price ($)", "name", None]) == ["Name", "_col1", "Unit_Price", "name_3", "_col4"]


def test_first_run_window_and_lookback(spark):
    b = spark.createDataFrame(
        [("old", datetime(1970, 1, 1), datetime(2024, 1, 1)), ("new", datetime(2024, 1, 1), datetime(2024, 1, 4)), ("none", datetime(2024, 2, 1), datetime(2024, 1, 1))],
        "e string, lo timestamp, hi timestamp",
    )
    got = [tuple(r) for r in Sc.plan_windows(b, "lo", "hi", 2, lookback_minutes=60).orderBy("e", "window_id").collect()]
    assert got == [
        ("new", 0, datetime(2023, 12, 31, 23), datetime(2024, 1, 2, 23)),
        ("new", 1, datetime(2024, 1, 2, 23), datetime(2024, 1, 4)),
        ("old", 0, datetime(1970, 1, 1), datetime(2024, 1, 1)),
    ]


def test_keyset_walk_loses_no_ties(spark):
    df = spark.createDataFrame([(i // 7, i) for i in range(100)], "c int, id int")
    seen, last = [], (None, None)
    while True:
        batch, mark = P.cap_records(df, "c", "id", 9, *last)
        ids = [r["id"] for r in batch.collect()]
        if not ids:
            break
        seen += ids
        last = tuple(mark.first())
    assert seen == list(range(100))
    with pytest.raises(ValueError):
        P.keyset_page(df, "c", "", 1, 1, 5)


def test_filters_reject_bad_input(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, s string")
    assert [r["id"] for r in Fl.apply_filters(df, [("x", "s", "ne")], {"x": "a"}).collect()] == [2]
    with pytest.raises(ValueError):
        Fl.filter_exact(df, ["s"], id=1)
    with pytest.raises(ValueError):
        Fl.report_condition({"filter": {"fieldName": "zz", "stringFilter": {"value": "a"}}}, {"s": F.col("s")})
    with pytest.raises(ValueError):
        R.select_fields(df, ["id", "nope"])


def test_report_limits(spark):
    with pytest.raises(ValueError):
        Rp.report(spark.range(1), None, ["d"], [])
    assert Rp.report_table_meta(["date", "x"]) == {
        "primary_keys": ["property_id", "date", "x"], "cursor_field": "date", "ingestion_type": "cdc",
    }
    assert Rp.relative_range("30daysAgo", date(2024, 1, 31), 3) == (date(2024, 1, 1), date(2024, 1, 31))
    assert len(Rp.NAMED_REPORTS) == 15


def test_clinical_chain_and_fallback(spark):
    raw = '{"resourceType":"Patient","id":"1","identifier":[{"system":"x"}],"extension":[{"url":"u"}]}'
    df = spark.createDataFrame([(raw,)], "raw string")
    assert "nhs_number" in Cl.clinical_extract(df, "raw", "Patient").columns
    assert "nhs_number" not in Cl.clinical_extract(df, "raw", "Patient", "base_r4").columns
    other = Cl.clinical_extract(df, "raw", "Unknown")
    assert other.columns == ["id", "resourceType", "lastUpdated", "raw_json", "extension"]
    row = Cl.clinical_extract(df, "raw", "Patient").first()
    assert row["name"] == [] and row["maritalStatus"] is None and row["extension"] == '[{"url":"u"}]'
    assert len(Cl.RESOURCES) == 14


def test_spec(spark):
    meta = {"t": {"primary_keys": ["id"], "cursor_field": "at"}}
    spec = {"connection_name": "c", "objects": [{"table": {"source_table": "t", "table_configuration": {"scd_type": "scd_type_2", "cluster_by": '["a","b"]', "x": 1}}}]}
    plan = In.table_plans(spec, meta)[0]
    assert (plan.keys, plan.sequence_by, plan.ingestion_type, plan.scd) == (["id"], "at", "cdc", 2)
    assert plan.cluster_by == ["a", "b"] and plan.options == {"x": "1"}
    for bad in (
        {"connection_name": " ", "objects": spec["objects"]},
        {"connection_name": "c", "objects": []},
        {**spec, "extra": 1},
        {"connection_name": "c", "objects": [{"table": {"source_table": "t", "table_configuration": {"scd_type": "x"}}}]},
    ):
        with pytest.raises(ValueError):
            In.table_plans(bad, meta)


def test_synth_is_repeatable(spark):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("at", T.TimestampType()), *NESTED.fields[:3]])
    a = Sy.synth_from_schema(spark, schema, 50, ["id"], "at", 3)
    b = Sy.synth_from_schema(spark, schema, 50, ["id"], "at", 3)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert a.select("id").distinct().count() == 50
