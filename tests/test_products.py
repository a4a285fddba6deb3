"""Daily products, contracts and coverage."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wattlake import schemas as S
from wattlake.operators import contracts, products
from wattlake.operators.flatten import flatten_flows, flatten_mix, good_rows
from wattlake.schemas import SOURCES

from test_flatten import documents


def readings(spark, *rows):
    """Silver mix rows from (zone, datetime, {source: mw})."""
    data = [(z, t, *[v.get(s) for s in SOURCES]) for z, t, v in rows]
    ddl = "zone string, datetime timestamp, " + ", ".join(f"{s}_mw double" for s in SOURCES)
    return spark.createDataFrame(data, ddl)


def flows(spark, *rows):
    """Silver flow rows from (zone, datetime, neighbour, direction, mw)."""
    return spark.createDataFrame(
        rows, "zone string, datetime timestamp, neighbor_zone string, direction string, power_mw double")


NINE, TEN = datetime(2026, 4, 23, 9), datetime(2026, 4, 23, 10)


def test_two_hours(spark):
    day = products.daily_mix(readings(
        spark, ("FR", NINE, {"nuclear": 100.0, "solar": 50.0}), ("FR", TEN, {"nuclear": 200.0, "solar": 50.0}),
    ), 7).collect()
    assert len(day) == 1
    row = day[0]
    assert (row.total_production_mwh, row.nuclear_pct, row.solar_pct, row.hours_covered) == (400.0, 75.0, 25.0, 2)
    assert (row.zone_name, row.process_ts, row.year, row.month, row.day) == ("France", 7, 2026, 4, 23)
    assert row.fossil_free_avg_pct == 100.0 and row.renewable_avg_pct == 25.0


def test_sample_payload(spark, mix_payload, flows_payload):
    row = products.daily_mix(good_rows(flatten_mix(documents(spark, mix_payload))), 1).first()
    expected = {
        "total_production_mwh": 9345.5, "nuclear_pct": 12.845755, "solar_pct": 10.545182, "hydro_pct": 41.463806,
        "wind_pct": 23.65577, "biomass_pct": 4.387138, "gas_pct": 6.853566, "oil_pct": 0.085603, "coal_pct": 0.16318,
        "geothermal_pct": 0.0, "unknown_pct": 0.0, "fossil_free_avg_pct": 92.897651, "renewable_avg_pct": 80.051897,
    }
    assert {k: round(row[k], 6) for k in expected} == expected and row.hours_covered == 1
    net = products.daily_net_flows(good_rows(flatten_flows(documents(spark, flows_payload))), 1)
    assert {r.source_zone: r.import_mwh for r in products.net_imports(net).collect()} == {"DE": 702.5, "CZ": 150.0}
    assert {r.destination_zone_name: r.export_mwh for r in products.net_exports(net).collect()} == {
        "Switzerland": 480.0, "SI": 95.25}


def test_no_production_and_negative_production(spark):
    rows = {r.zone: r for r in products.daily_mix(readings(
        spark, ("ZERO", NINE, {"wind": 0.0}), ("NULL", NINE, {}), ("NEG", NINE, {"wind": -5.0, "coal": 10.0}),
        ("NAN", NINE, {"wind": float("nan")}),
    ), 1).collect()}
    assert rows["ZERO"].wind_pct == 0.0 and rows["NULL"].total_production_mwh == 0.0
    assert rows["NEG"].wind_pct == -100.0 and rows["NEG"].coal_pct == 200.0
    assert rows["NAN"].wind_pct == 0.0 and rows["ZERO"].zone_name == "ZERO"


def test_net_zero_is_in_neither_product(spark):
    net = products.daily_net_flows(flows(
        spark, ("FR", NINE, "DE", "import", 5.0), ("FR", TEN, "DE", "export", 5.0),
        ("FR", NINE, "BE", "import", 5.0), ("FR", NINE, "BE", "export", 7.0), ("FR", TEN, "ES", "import", None),
    ), 1)
    assert products.net_imports(net).count() == 0
    assert [(r.destination_zone, r.export_mwh, r.hours_covered) for r in products.net_exports(net).collect()] == [
        ("BE", 2.0, 1)]
    assert {r.neighbor_zone: r.hours_covered for r in net.collect()} == {"DE": 2, "BE": 1, "ES": 1}


def test_sample_length_factor(spark):
    rows = readings(spark, ("FR", NINE, {"wind": 8.0}))
    assert products.daily_mix(rows, 1, hours_per_sample=0.25).first().total_production_mwh == 2.0


def test_coverage_and_missing_hours(spark):
    gold = spark.createDataFrame(
        [("FR", datetime(2026, 4, 1).date(), 24), ("FR", datetime(2026, 4, 4).date(), 3)],
        "zone string, date date, hours_covered int")
    row = products.coverage(gold, F.lit("2026-04-10").cast("date")).first()
    assert (row.n_days, row.incomplete_days, row.missing_days, row.stale_days) == (2, 1, 2, 6)
    rows = readings(spark, ("FR", NINE, {}), ("DE", TEN, {}), ("DE", datetime(2026, 4, 23, 9, 30), {}))
    gaps = products.missing_hours(rows, F.lit(NINE), F.lit(datetime(2026, 4, 23, 11)))
    assert sorted((r.zone, r.datetime.hour) for r in gaps.collect()) == [("DE", 11), ("FR", 10), ("FR", 11)]


# ---------------------------------------------------------------- contracts

def gold_row(spark, **changes):
    df = products.daily_mix(readings(spark, ("FR", NINE, {"wind": 1.0})), 1)
    return df.withColumns({k: F.lit(v) for k, v in changes.items()})


def test_gold_contract(spark):
    assert contracts.GOLD_MIX.enforce(gold_row(spark), "gold").count() == 1
    with pytest.raises(contracts.ContractViolation) as failure:
        contracts.GOLD_MIX.enforce(gold_row(spark, wind_pct=-1.0, hours_covered=25), "gold")
    assert failure.value.counts == {"range:wind_pct": 1, "range:hours_covered": 1}
    # summed percentages may exceed 100 by a rounding error, and percentages may be null
    assert contracts.GOLD_MIX.enforce(gold_row(spark, fossil_free_avg_pct=100.0 + 1e-12), "gold").count() == 1
    assert contracts.GOLD_MIX.enforce(gold_row(spark, wind_pct=None), "gold").count() == 1


def test_silver_flow_contract_splits(spark):
    base = (1, "FR", NINE, NINE, "DE", "import", 1.0, 2026, 4, 23)
    rows = [base, base[:5] + ("sideways",) + base[6:], base[:6] + (None,) + base[7:]]
    good, bad = contracts.SILVER_FLOWS.split(spark.createDataFrame(rows, S.SILVER_FLOWS))
    assert good.count() == 1
    assert sorted(r.violations[0] for r in bad.collect()) == ["allowed:direction", "not_null:power_mw"]
    quarantined = contracts.violating_rows_as_bad_data(bad)
    assert quarantined.columns == S.BAD_DATA.fieldNames()


def test_coercion_failures_are_violations(spark):
    df = spark.createDataFrame(
        [("1", "FR", NINE, "x"), ("many", "DE", NINE, "2.5")],
        "process_ts string, zone string, datetime timestamp, power_mw string")
    contract = contracts.Contract(
        S.T.StructType([S.SILVER_FLOWS["process_ts"], S.SILVER_FLOWS["power_mw"]]), ["zone"])
    found = {r.zone: (r.process_ts, r.power_mw, r.violations) for r in contract.check(df).collect()}
    assert found == {"FR": (1, None, ["type:power_mw"]), "DE": (None, 2.5, ["type:process_ts"])}


def test_negative_power_passes_silver(spark):
    rows = [(1, "FR", NINE, NINE, "DE", "import", -100.0, 2026, 4, 23)]
    assert contracts.SILVER_FLOWS.split(spark.createDataFrame(rows, S.SILVER_FLOWS))[0].count() == 1
