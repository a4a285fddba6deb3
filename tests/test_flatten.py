"""Flattening and quarantine of raw documents."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from wattlake.functions.timecols import iso_timestamp
from wattlake.operators.flatten import bad_rows, flatten_flows, flatten_mix, good_rows


def documents(spark, *texts, zone="FR"):
    rows = [(1, zone, t if isinstance(t, str) else json.dumps(t)) for t in texts]
    return spark.createDataFrame(rows, "process_ts bigint, zone string, raw_json string")


def record(**changes):
    rec = {"datetime": "2026-04-23T09:00:00Z", "updatedAt": "2026-04-23T10:00:00Z", "mix": {"nuclear": 1.5}}
    rec.update(changes)
    return {k: v for k, v in rec.items() if v != "DROP"}


def mix_codes(spark, *records):
    flat = flatten_mix(documents(spark, {"data": list(records)}))
    return [r.error_code for r in flat.select("error_code").collect()]


def test_sample_mix(spark, mix_payload):
    flat = flatten_mix(documents(spark, mix_payload))
    row = good_rows(flat).first()
    assert bad_rows(flat).count() == 0
    assert (row.nuclear_mw, row.hydro_storage_discharge_mw, row.battery_storage_charge_mw) == (1200.5, 512.25, 6.5)
    assert row.hydro_storage_charge_mw is None and row.geothermal_mw is None
    assert (row.flow_exports_mw, row.flow_imports_mw, row.coal_mw) == (1450.5, 905.0, 15.25)
    assert row.is_estimated is False and row.estimation_method == "OWN_TEST_VALUES"
    assert (row.year, row.month, row.day) == (2026, 5, 14) and row.datetime == datetime(2026, 5, 14, 14)


@pytest.mark.parametrize("flatten", [flatten_mix, flatten_flows])
@pytest.mark.parametrize("text,code", [
    ("{ malformed }", "MALFORMED_JSON"),
    ("[1, 2]", "MALFORMED_JSON"),
    ("", "MALFORMED_JSON"),
    ('{"data": []} and more', "MALFORMED_JSON"),
    ('{"data": []}{"data": []}', "MALFORMED_JSON"),
    ("{'data': []}", "MALFORMED_JSON"),
    ('{"data": []', "MALFORMED_JSON"),
    ('{"data": null}', "DATA_NOT_A_LIST"),
    ('{"data": "x"}', "DATA_NOT_A_LIST"),
    ('{"data": {"a": 1}}', "DATA_NOT_A_LIST"),
])
def test_unreadable_documents(spark, flatten, text, code):
    flat = flatten(documents(spark, text))
    bad = bad_rows(flat).collect()
    assert good_rows(flat).count() == 0
    assert [(b.error_message, b.raw_json, b.datetime) for b in bad] == [(code, text, "unknown")]


@pytest.mark.parametrize("flatten", [flatten_mix, flatten_flows])
@pytest.mark.parametrize("text", ['{"data": []}', '{"zone": "FR"}', "{}"])
def test_documents_without_records(spark, flatten, text):
    assert flatten(documents(spark, text)).count() == 0


@pytest.mark.parametrize("rec,code", [
    (record(), None),
    (record(datetime="DROP"), "MISSING_DATETIME"),
    (record(datetime=None), "MISSING_DATETIME"),
    (record(datetime="soon"), "BAD_DATETIME"),
    (record(datetime="2026"), "BAD_DATETIME"),
    (record(datetime="2026-13-01T00:00:00Z"), "BAD_DATETIME"),
    (record(updatedAt="DROP"), "MISSING_UPDATED_AT"),
    (record(updatedAt="later"), "BAD_UPDATED_AT"),
    (record(mix=None), "MIX_NOT_AN_OBJECT"),
    (record(mix=[1]), "MIX_NOT_AN_OBJECT"),
    (record(mix="DROP"), None),
    (record(mix={}), None),
    (record(mix={"hydro storage": 5, "flows": "none"}), None),
    (7, "RECORD_NOT_AN_OBJECT"),
    ("text", "RECORD_NOT_AN_OBJECT"),
])
def test_record_errors(spark, rec, code):
    assert mix_codes(spark, record(), rec, record()) == [None, code, None]


def test_bad_record_keeps_its_text_and_time(spark):
    text = '{"datetime": "soon",  "b": 1, "a": 2}'
    bad = bad_rows(flatten_mix(documents(spark, '{"data": [' + text + ', {"datetime": ""}, 3]}'))).collect()
    # blanks between tokens are not kept, the keys and their order are
    assert bad[0].raw_json == text.replace(" ", "")
    assert [b.datetime for b in bad] == ["soon", "unknown", "unknown"]


def test_numbers_are_typed_leniently(spark):
    rec = record(mix={"nuclear": "12.5", "wind": "calm", "solar": None, "gas": -3, "hydro storage": {"charge": 2}})
    row = good_rows(flatten_mix(documents(spark, {"data": [rec]}))).first()
    assert (row.nuclear_mw, row.wind_mw, row.solar_mw, row.gas_mw, row.hydro_storage_charge_mw) == (
        12.5, None, None, -3.0, 2.0)


def test_flows_unpivot(spark, flows_payload):
    flat = flatten_flows(documents(spark, flows_payload))
    rows = {(r.neighbor_zone, r.direction): r.power_mw for r in good_rows(flat).collect()}
    assert rows == {("DE", "import"): 702.5, ("CZ", "import"): 150.0, ("CH", "export"): 480.0, ("SI", "export"): 95.25}


def test_flow_values(spark):
    base = {"datetime": "2026-04-23T09:00:00Z", "updatedAt": "2026-04-23T10:00:00Z"}
    payload = {"data": [
        {**base, "import": {"BE": None}, "export": None},
        {**base},
        {**base, "import": {"BE": "2.5"}},
        {**base, "import": {"BE": 1, "CH": "much"}, "export": {"DE": 3}},
        {**base, "import": [1]},
        {**base, "import": {}, "export": []},
    ]}
    flat = flatten_flows(documents(spark, payload))
    assert sorted((r.neighbor_zone, r.power_mw) for r in good_rows(flat).collect()) == [("BE", 0.0), ("BE", 2.5)]
    # a record with one bad entry is set aside as a whole
    assert sorted(r.error_message for r in bad_rows(flat).collect()) == ["BAD_POWER", "FLOWS_NOT_AN_OBJECT"]


def test_day_columns_follow_utc(spark):
    row = good_rows(flatten_mix(documents(spark, {"data": [record(datetime="2026-04-24T01:00:00+02:00")]}))).first()
    assert (row.year, row.month, row.day) == (2026, 4, 23)


@pytest.mark.parametrize("text,expected", [
    ("2026-04-23T09:00:00.000Z", datetime(2026, 4, 23, 9)),
    ("2026-04-23T09:00:00+02:00", datetime(2026, 4, 23, 7)),
    ("2026-04-23T09:00:00", datetime(2026, 4, 23, 9)),
    ("2026-04-23 09:00", datetime(2026, 4, 23, 9)),
    ("2026-04-23", datetime(2026, 4, 23)),
    ("20260423T090000", datetime(2026, 4, 23, 9)),
    ("20260423T0900-0130", datetime(2026, 4, 23, 10, 30)),
    ("2026-04-23T09:00:00.1234567Z", datetime(2026, 4, 23, 9, 0, 0, 123456)),
    ("2026-04-23T09+02", datetime(2026, 4, 23, 7)),
    ("2026", None), ("2026-04", None), ("23.04.2026", None), ("", None), ("now", None),
    ("2026-02-30", None), ("2026-0423", None), ("2026-04-23T25:00:00Z", None),
])
def test_iso_timestamp(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(F.to_timestamp_ntz(F.date_format(iso_timestamp(F.col("t")), "yyyy-MM-dd HH:mm:ss.SSSSSS"))).first()[0]
    assert got == expected


def test_iso_timestamp_agrees_with_python(spark):
    dates = ["2026-04-23", "20260423", "2026-4-23", "2026-04", "2024-02-29", "2023-02-29", "2026-13-01", "2026-0423"]
    separators = ["T", " ", "_", "", "TT"]
    times = ["09", "09:30", "0930", "09:30:15", "093015", "09:30:15.5", "09:30:15.1234567", "09:30:15,25", "24:00",
             "09:60", "9:30", "", "0930:15", "09:3015"]
    offsets = ["", "Z", "z", "+02:00", "-0130", "+02", "+02:00:30", "+24:00", "+23:59", "-18:30", "+2", "+0200:30"]
    texts = sorted({d + s + t + o for d in dates for s in separators for t in times for o in offsets})

    def python(text):
        try:
            parsed = datetime.fromisoformat(text)
        except ValueError:
            return None
        parsed = parsed if parsed.tzinfo else parsed.replace(tzinfo=timezone.utc)
        return parsed.astimezone(timezone.utc).replace(tzinfo=None)

    stamp = F.to_timestamp_ntz(F.date_format(iso_timestamp(F.col("t")), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", stamp.alias("ts")).collect()
    assert [(r.t, r.ts, python(r.t)) for r in rows if r.ts != python(r.t)] == []
