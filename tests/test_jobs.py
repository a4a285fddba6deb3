"""The layer jobs end to end, the ledger, write modes and the SQL surface."""

import copy
import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import SparkRuntimeException

from wattlake import schemas as S
from wattlake.operators.contracts import ContractViolation
from wattlake.operators.keys import DuplicateKeyError
from wattlake.operators.ledger import Ledger
from wattlake.plans.jobs import Lake, ingest_bronze, transform_gold, transform_silver
from wattlake.plans.sql_surface import INSPECTIONS, ForeignTable, NotAReadOnlyQuery, SqlSurface
from wattlake.sources import tables


def payloads(spark, *documents):
    return spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in documents], "raw_json string")


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def land(lake, mix, flows, process_ts):
    return ingest_bronze(lake, payloads(lake.spark, *mix), payloads(lake.spark, *flows), process_ts)


def status(lake):
    return {(r.process, r.process_ts): r.status for r in lake.ledger.state().collect()}


def read(lake, layer, name, schema):
    return tables.read_table(lake.spark, lake.path(layer, name), schema)


def test_whole_cycle(lake, mix_payload, flows_payload):
    assert transform_silver(lake, 5)["status"] == "no_pending"
    assert transform_gold(lake, 5)["status"] == "no_pending"
    landed = land(lake, [mix_payload], [flows_payload], 10)
    assert (landed["mix_records"], landed["flows_records"], landed["process_ts"]) == (1, 1, 10)
    assert tables.table_exists(lake.spark, landed["mix_table"])
    silver = transform_silver(lake, 20)
    assert silver == {"process_ts": 20, "bronze_batches_consumed": 1, "mix_records": 1, "flows_records": 4,
                      "bad_mix_records": 0, "bad_flows_records": 0}
    assert status(lake) == {("bronze", 10): "C", ("silver", 20): "R"}
    gold = transform_gold(lake, 30)
    assert gold == {"process_ts": 30, "silver_batches_consumed": 1, "mix_records": 1, "imports_records": 2,
                    "exports_records": 2}
    assert status(lake) == {("bronze", 10): "C", ("silver", 20): "C", ("gold", 30): "R"}
    assert round(read(lake, "gold", "daily_electricity_mix", S.GOLD_MIX).first().nuclear_pct, 6) == 12.845755


def test_landing_files(lake, mix_payload, flows_payload, tmp_path):
    for kind, doc in (("mix", mix_payload), ("flows", flows_payload)):
        (tmp_path / kind).mkdir()
        (tmp_path / kind / "a.json").write_text(json.dumps(doc, indent=1))
        (tmp_path / kind / "b.json").write_text('{"zone": "DE"}')
    result = ingest_bronze(lake, str(tmp_path / "mix"), str(tmp_path / "flows"), 10)
    assert result["mix_records"] == 1
    rows = {r.zone: r for r in read(lake, "bronze", "electricity_mix", S.BRONZE).collect()}
    assert rows["AT"].record_count == 1 and rows["DE"].record_count == 0
    assert "/electricity-mix/past-range?zone=AT&start=" in rows["AT"].source_url
    assert rows["AT"].range_end - rows["AT"].range_start == timedelta(hours=24)


def test_files_are_landed_once(lake, mix_payload, tmp_path):
    for kind in ("mix", "flows"):
        (tmp_path / kind / "deep").mkdir(parents=True)
    (tmp_path / "mix" / "a.json").write_text(json.dumps(mix_payload))

    def run(ts):
        return ingest_bronze(lake, str(tmp_path / "mix"), str(tmp_path / "flows"), ts)["mix_records"]

    assert run(1) == 1 and run(2) == 0
    (tmp_path / "mix" / "deep" / "b.json").write_text(json.dumps(mix_payload))
    assert run(3) == 1 and run(4) == 0
    batches = [r.process_ts for r in read(lake, "bronze", "electricity_mix", S.BRONZE).collect()]
    assert sorted(batches) == [1, 3]


@pytest.mark.parametrize("stop_at", ["flows", "mark_ready", "mark_ready, lost"])
def test_files_of_a_batch_that_was_never_ready_are_landed_again(lake, mix_payload, flows_payload, tmp_path, monkeypatch, stop_at):
    for kind, payload in (("mix", mix_payload), ("flows", flows_payload)):
        (tmp_path / kind).mkdir()
        (tmp_path / kind / "a.json").write_text(json.dumps(payload))
    mix, flows = str(tmp_path / "mix"), str(tmp_path / "flows")
    stop = KeyboardInterrupt if "lost" in stop_at else ZeroDivisionError

    def stopped(*args, **values):
        raise stop

    with monkeypatch.context() as patch:
        if stop_at != "flows":
            patch.setattr(Ledger, "mark_ready", stopped)
        with pytest.raises(stop):
            ingest_bronze(lake, mix, stopped if stop_at == "flows" else flows, 10)
    again = ingest_bronze(lake, mix, flows, 20)
    assert (again["mix_records"], again["flows_records"]) == (1, 1)
    silver = transform_silver(lake, 30)
    assert (silver["mix_records"], silver["flows_records"]) == (1, 4)
    after = ingest_bronze(lake, mix, flows, 40)
    assert (after["mix_records"], after["flows_records"]) == (0, 0)


STEPS = [("silver", "claim", True), ("silver", "days_of", False), ("silver", "mark_ready", True), ("silver", "mark_complete", True),
         ("gold", "claim", False), ("gold", "mark_ready", True), ("gold", "mark_complete", True)]


@pytest.mark.parametrize("layer, step, lost", STEPS)
def test_a_stop_at_any_step_leaves_a_retry_the_same_result(lake, mix_payload, flows_payload, monkeypatch, layer, step, lost):
    """``lost``: the driver is gone, nothing is recorded any more."""
    land(lake, [mix_payload], [flows_payload], 10)
    job = {"silver": transform_silver, "gold": transform_gold}[layer]
    if layer == "gold":
        transform_silver(lake, 20)
    original, stop = getattr(Ledger, step), KeyboardInterrupt if lost else ZeroDivisionError

    def stopped(self, process, *args, **values):
        if step in ("claim", "days_of"):
            original(self, process, *args, **values)
        raise stop

    with monkeypatch.context() as patch:
        patch.setattr(Ledger, step, stopped)
        with pytest.raises(stop):
            job(lake, 25)
    if layer == "silver":
        transform_silver(lake, 30)
    gold = transform_gold(lake, 40)
    assert gold.get("status") == "no_pending" or (gold["mix_records"], gold["imports_records"], gold["exports_records"]) == (1, 2, 2)
    row = read(lake, "gold", "daily_electricity_mix", S.GOLD_MIX).collect()
    assert len(row) == 1 and round(row[0].nuclear_pct, 6) == 12.845755
    left = {k: v for k, v in status(lake).items() if v in ("P", "R") and k[0] != "gold"}
    assert not left
    assert transform_silver(lake, 50)["status"] == "no_pending" and transform_gold(lake, 60)["status"] == "no_pending"


def test_failed_fetch_is_recorded(lake):
    def broken(start, end):
        raise RuntimeError("source is down")

    with pytest.raises(RuntimeError, match="source is down"):
        ingest_bronze(lake, broken, broken, 11)
    row = lake.ledger.state().first()
    assert row.status == "I" and "source is down" in row.error_message


def test_quarantine(lake, mix_payload):
    negative = copy.deepcopy(mix_payload)
    negative["data"][0]["mix"]["nuclear"] = -100.0
    land(lake, [negative, "{ malformed }"], [{"data": []}], 10)
    first = transform_silver(lake, 20)
    assert (first["mix_records"], first["bad_mix_records"]) == (1, 1)
    del mix_payload["data"][0]["datetime"]
    land(lake, [mix_payload], [{"data": []}], 11)
    assert transform_silver(lake, 21)["bad_mix_records"] == 1
    bad = read(lake, "silver", "silver_mix_bad_data", S.BAD_DATA)
    assert sorted(r.error_message for r in bad.collect()) == ["MALFORMED_JSON", "MISSING_DATETIME"]
    assert not tables.table_exists(lake.spark, lake.path("silver", "silver_flows_bad_data"))


def test_batch_without_good_rows(lake):
    land(lake, ["{ malformed }"], [{"data": []}], 10)
    assert transform_silver(lake, 20)["bad_mix_records"] == 1
    gold = transform_gold(lake, 30)
    assert (gold["mix_records"], gold["imports_records"], gold["exports_records"]) == (0, 0, 0)
    assert status(lake)[("silver", 20)] == "C"


def test_failed_silver_hands_its_batches_back(lake, mix_payload, monkeypatch):
    land(lake, [mix_payload], [{}], 10)
    monkeypatch.setattr("wattlake.plans.jobs.tables.upsert_by_keys", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        transform_silver(lake, 20)
    assert status(lake) == {("bronze", 10): "R", ("silver", 20): "I"}
    monkeypatch.undo()
    assert transform_silver(lake, 21)["mix_records"] == 1


def test_silver_without_known_days_is_scanned_for_them(lake, mix_payload, flows_payload, monkeypatch):
    land(lake, [mix_payload], [flows_payload], 10)
    monkeypatch.setattr(Ledger, "days_of", lambda *a: None)
    assert transform_silver(lake, 20)["flows_records"] == 4
    assert transform_gold(lake, 30)["imports_records"] == 2


def test_gold_failure_leaves_silver_ready(lake, mix_payload, flows_payload):
    mix_payload["data"][0]["mix"]["nuclear"] = -100.0
    land(lake, [mix_payload], [flows_payload], 10)
    transform_silver(lake, 20)
    with pytest.raises(ContractViolation, match="range:nuclear_pct"):
        transform_gold(lake, 30)
    assert status(lake)[("gold", 30)] == "I" and status(lake)[("silver", 20)] == "R"
    assert not tables.table_exists(lake.spark, lake.path("gold", "daily_imports"))


def test_late_data_recomputes_whole_day_only(lake, mix_payload, flows_payload):
    other_day = copy.deepcopy(mix_payload)
    other_day["data"][0]["datetime"] = "2026-05-11T14:00:00Z"
    land(lake, [mix_payload, other_day], [flows_payload], 10)
    transform_silver(lake, 20)
    transform_gold(lake, 30)
    late = copy.deepcopy(mix_payload)
    late["data"][0]["datetime"] = "2026-05-14T15:00:00Z"
    land(lake, [late], [{"data": []}], 11)
    transform_silver(lake, 21)
    transform_gold(lake, 31)
    rows = {(r.day, r.process_ts, r.hours_covered) for r in read(lake, "gold", "daily_electricity_mix", S.GOLD_MIX).collect()}
    assert rows == {(11, 30, 1), (14, 31, 2)}
    # flows of the touched day are recomputed as well
    assert {r.process_ts for r in read(lake, "gold", "daily_imports", S.GOLD_IMPORTS).collect()} == {31}


def test_later_batch_wins_and_latest_option(lake, mix_payload):
    def with_value(value, updated):
        doc = copy.deepcopy(mix_payload)
        doc["data"][0]["mix"]["nuclear"], doc["data"][0]["updatedAt"] = value, updated
        return doc

    def value():
        return read(lake, "silver", "electricity_mix", S.SILVER_MIX).first().nuclear_mw

    # within one batch the newest update wins
    land(lake, [with_value(1.0, "2026-04-25T00:00:00Z"), with_value(2.0, "2026-04-26T00:00:00Z")], [{}], 10)
    transform_silver(lake, 20)
    assert value() == 2.0
    land(lake, [with_value(3.0, "2026-04-24T00:00:00Z")], [{}], 11)
    transform_silver(lake, 21, keep="latest")
    assert value() == 2.0
    land(lake, [with_value(4.0, "2026-04-24T00:00:00Z")], [{}], 12)
    transform_silver(lake, 22)
    assert value() == 4.0


# ---------------------------------------------------------------- ledger

def test_ledger_transitions(lake):
    ledger = lake.ledger
    assert ledger.claim_ready("bronze") == [] and ledger.last_process_ts("bronze") is None
    ledger.open("bronze", 1000)
    ledger.mark_ready("bronze", 1000, 7)
    ledger.open("bronze", 2000)
    ledger.mark_error("bronze", 2000, "lost")
    state = {r.process_ts: r for r in ledger.state().collect()}
    assert (state[1000].status, state[1000].record_count) == ("R", 7)
    assert state[1000].start_timestamp is not None and state[1000].end_timestamp is not None
    assert (state[2000].status, state[2000].error_message, state[2000].record_count) == ("I", "lost", None)
    assert ledger.claim_ready("bronze") == [1000] and ledger.claim_ready("bronze") == []
    ledger.mark_complete("bronze", [1000])
    assert status(lake)[("bronze", 1000)] == "C"
    assert ledger.last_process_ts("bronze") == datetime(1970, 1, 1, 0, 0, 2, tzinfo=timezone.utc)


def test_checkpointed_ledger_says_the_same_and_keeps_its_history(lake, monkeypatch):
    ledger = lake.ledger
    for ts in (1, 2, 3):
        ledger.open("bronze", ts)
        ledger.mark_ready("bronze", ts, ts * 10, days=[(2026, 4, ts)])
    ledger.mark_error("silver", 9, "lost")
    before, told = sorted(map(str, ledger.state().collect())), sorted(map(str, ledger.history().collect()))
    assert len(told) == 7
    for _ in range(2):
        ledger.checkpoint()
        assert all(f.endswith(".parquet") for f in ledger.log().inputFiles())
        assert sorted(map(str, ledger.state().collect())) == before and sorted(map(str, ledger.history().collect())) == told
    assert ledger.days_of("bronze", [1, 3]) == [(2026, 4, 1), (2026, 4, 3)]
    assert ledger.days_of("silver", [9]) is None
    monkeypatch.setattr("wattlake.operators.ledger.CHECKPOINT_EVERY", 1)
    ledger.open("bronze", 4)
    assert ledger.claim_ready("bronze") == [1, 2, 3]
    ledger.mark_complete("bronze", [1])
    assert status(lake) == {("bronze", 1): "C", ("bronze", 2): "P", ("bronze", 3): "P", ("bronze", 4): "I",
                            ("silver", 9): "I"}


def test_catch_up_window(lake):
    now = datetime(2026, 4, 23, 12, 34, tzinfo=timezone.utc)
    hour = timedelta(hours=1)
    ledger = Ledger(lake.spark, lake.root)
    end = datetime(2026, 4, 23, 12, tzinfo=timezone.utc)
    assert ledger.next_window("bronze", now=now) == (end - 24 * hour, end)
    # five hours of outage give five hours of work; the running and failed batches do not count
    ledger.open("bronze", 1)
    ledger.mark_ready("bronze", 1, 0, range_end=end - 5 * hour)
    ledger.open("bronze", 2)
    ledger.mark_error("bronze", 2, "down")
    ledger.open("bronze", 3)
    assert ledger.next_window("bronze", 3, now) == (end - 5 * hour, end)
    ledger.mark_ready("bronze", 3, 0, range_end=end)
    assert ledger.next_window("bronze", 4, now) == (end - hour, end)


# ---------------------------------------------------------------- write modes

def flow_rows(spark, *rows):
    """Flow rows from (day, neighbour, mw)."""
    data = [(1, "FR", datetime(2026, 4, d), datetime(2026, 4, d), n, "import", mw, 2026, 4, d) for d, n, mw in rows]
    return spark.createDataFrame(data, S.SILVER_FLOWS)


def content(spark, path):
    return sorted((r.day, r.neighbor_zone, r.power_mw)
                  for r in tables.read_table(spark, path, S.SILVER_FLOWS).collect())


def test_upsert_is_idempotent_and_touches_only_its_days(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert_by_keys(flow_rows(spark, (1, "DE", 1.0), (2, "DE", 2.0), (2, "BE", 3.0)), path, S.FLOW_KEYS, S.SILVER_FLOWS)
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("year=2026/month=4/day=1/*.parquet")}
    for _ in range(2):
        days = tables.upsert_by_keys(flow_rows(spark, (2, "DE", 9.0), (3, "ES", 4.0)), path, S.FLOW_KEYS, S.SILVER_FLOWS)
        assert days == [(2026, 4, 2), (2026, 4, 3)]
        assert content(spark, path) == [(1, "DE", 1.0), (2, "BE", 3.0), (2, "DE", 9.0), (3, "ES", 4.0)]
    assert untouched and all(p.stat().st_mtime_ns == t for p, t in untouched.items())


def test_upsert_rejects_duplicates(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(DuplicateKeyError, match="incoming rows"):
        tables.upsert_by_keys(flow_rows(spark, (1, "DE", 1.0), (1, "DE", 2.0)), path, S.FLOW_KEYS, S.SILVER_FLOWS)
    tables.append(flow_rows(spark, (1, "DE", 1.0), (1, "DE", 2.0)), path, S.DAY_COLUMNS)
    with pytest.raises(DuplicateKeyError, match="table rows"):
        tables.upsert_by_keys(flow_rows(spark, (1, "BE", 1.0)), path, S.FLOW_KEYS, S.SILVER_FLOWS)
    assert tables.upsert_by_keys(flow_rows(spark), path, S.FLOW_KEYS, S.SILVER_FLOWS) == []


def test_replace_days(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append(flow_rows(spark, (1, "DE", 1.0), (2, "DE", 2.0), (3, "DE", 3.0)), path, S.DAY_COLUMNS)
    tables.replace_days(flow_rows(spark, (2, "BE", 5.0)), path, [(2026, 4, 2), (2026, 4, 3)], S.FLOW_KEYS)
    assert content(spark, path) == [(1, "DE", 1.0), (2, "BE", 5.0)]
    tables.replace_days(flow_rows(spark), path, [(2026, 4, 1), (2026, 4, 2)], S.FLOW_KEYS)
    assert content(spark, path) == []
    with pytest.raises(ValueError, match="outside"):
        tables.replace_days(flow_rows(spark, (5, "BE", 5.0)), path, [(2026, 4, 2)], S.FLOW_KEYS)


def test_missing_table_and_days(spark, tmp_path):
    path = str(tmp_path / "none")
    assert tables.read_table(spark, path, S.GOLD_MIX).schema.fieldNames() == S.GOLD_MIX.fieldNames()
    assert tables.read_days(spark, path, S.SILVER_FLOWS, [(2026, 4, 1)]).count() == 0
    tables.append(flow_rows(spark, (1, "DE", 1.0), (2, "DE", 2.0)), path, S.DAY_COLUMNS)
    assert tables.read_days(spark, path, S.SILVER_FLOWS, []).count() == 0
    pruned = tables.read_days(spark, path, S.SILVER_FLOWS, [(2026, 4, 2)])
    assert [r.power_mw for r in pruned.collect()] == [2.0]
    text = pruned._jdf.queryExecution().executedPlan().toString()
    assert "* 10000" in text.split("PartitionFilters: [")[1].split("PushedFilters")[0]


def test_union_widens_types(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([(2**40, True)], "n bigint, extra boolean")
    both = tables.union_all([a, b])
    assert dict(both.dtypes)["n"] == "bigint" and both.count() == 2


def test_batch_extract(spark, tmp_path):
    path = tables.write_extract(flow_rows(spark, (1, "DE", 1.0)), str(tmp_path), "silver", "flows", 1745489400000)
    assert path.endswith("/silver/2025/04/24/1745489400000/flows")
    assert spark.read.parquet(path).count() == 1


# ---------------------------------------------------------------- SQL

def test_sql_surface(lake, mix_payload, flows_payload):
    surface = SqlSurface(lake)
    assert surface.register() == ["state.el_state"]
    land(lake, [mix_payload], [flows_payload], 10)
    transform_silver(lake, 20)
    transform_gold(lake, 30)
    assert len(surface.register()) == 8
    for table, rows in INSPECTIONS.values():
        assert 1 <= surface.latest_rows(table, rows).count() <= rows
    for name in ("gold.daily_exports", "daily_exports", '"gold.daily_exports"'):
        assert surface.sql(f"SELECT count(*) AS n FROM {name}").first().n == 2
    share = surface.sql("SELECT renewable_avg_pct AS p FROM gold.daily_electricity_mix WHERE zone = :z AND date = :d",
                        {"z": "AT", "d": datetime(2026, 5, 14).date()}).first().p
    assert round(share, 6) == 80.051897
    top = surface.bounded("SELECT destination_zone, sum(export_mwh) AS e FROM gold.daily_exports "
                          "GROUP BY ALL ORDER BY e DESC LIMIT 3;")
    assert [r.destination_zone for r in top.collect()] == ["CH", "SI"]
    assert surface.bounded("WITH m AS (SELECT * FROM daily_imports) SELECT * FROM m", rows=1).count() == 1
    for text in ("SELECT 'el_state' AS x", "SELECT 'reflect(' || 'parquet.`x`' AS x FROM daily_imports",
                 "SELECT x.z FROM (SELECT zone AS z FROM daily_imports WHERE zone IN (SELECT zone FROM gold.daily_exports)) x",
                 'SELECT "zone" FROM "gold.daily_imports" ORDER BY 1', "SELECT zone, rank() OVER (ORDER BY import_mwh) FROM daily_imports"):
        assert surface.bounded(text).count() >= 1
    for bad in ("DROP TABLE gold.daily_exports", "INSERT INTO gold.daily_imports SELECT * FROM gold.daily_imports",
                "SELECT * FROM bronze.electricity_mix", "SELECT 1; SELECT 2", "SELECT * FROM parquet.`/etc`",
                "SELECT reflect('java.lang.System', 'nanoTime')", "SELECT * FROM identifier('bronze' || '.x')",
                "SELECT reflect/**/('java.lang.System', 'nanoTime')", "SELECT `reflect`('java.lang.System', 'nanoTime')",
                "SELECT * FROM IDENTIFIER/**/('bronze.electricity' || '_mix')", "SELECT * FROM parquet/**/.`/etc`",
                "SELECT (SELECT max(process_ts) FROM state.el_state)", "WITH x AS (SELECT * FROM silver.electricity_mix) SELECT * FROM x",
                "SELECT * FROM daily_imports WHERE EXISTS (SELECT 1 FROM el_state)", "SELECT * FROM range(10)",
                "SELECT * FROM daily_imports WHERE zone IN (SELECT java_method('java.lang.System', 'getProperty', 'x'))",
                "SELECT TRANSFORM(zone) USING 'cat' AS z FROM daily_imports", "SELECT input_file_name() FROM daily_imports",
                "WITH el_state AS (SELECT * FROM el_state) SELECT * FROM el_state",
                "WITH private AS (SELECT * FROM private) SELECT * FROM private",
                "SELECT * FROM (WITH el_state AS (SELECT 1 AS x) SELECT * FROM el_state) a JOIN el_state USING (x)",
                "WITH a AS (SELECT * FROM el_state), el_state AS (SELECT 1 AS x) SELECT * FROM a",
                "WITH RECURSIVE r AS (SELECT 1 AS x UNION ALL SELECT x + 1 FROM r) SELECT * FROM r",
                "SELECT collect_list(zone) FROM daily_imports", "SELECT zone, zone FROM daily_imports"):
        with pytest.raises(NotAReadOnlyQuery):
            surface.bounded(bad)
    inner = surface.bounded("WITH el_state AS (SELECT zone FROM daily_imports), b AS (SELECT * FROM el_state) "
                            "SELECT b.zone FROM b JOIN el_state ON (b.zone = el_state.zone) "
                            "WHERE b.zone IN (SELECT zone FROM el_state)")
    assert inner.count() == 4
    assert surface.bounded("SELECT rpad(zone, 60000, 'x') AS z FROM daily_imports").count() == 2
    with pytest.raises(SparkRuntimeException, match="longer than 65536 bytes"):
        surface.bounded("SELECT rpad(zone, 70000, 'x') AS z FROM daily_imports").collect()
    for view in ("state.el_state", "el_state"):
        assert surface.sql(f"SELECT * FROM {view}").count() == 3


def test_foreign_tables_survive(spark, lake, mix_payload, flows_payload):
    spark.sql("CREATE DATABASE IF NOT EXISTS mine_gold")
    spark.sql("CREATE OR REPLACE TEMP VIEW one AS SELECT 1 AS x")
    spark.sql("CREATE TABLE mine_gold.daily_imports USING parquet AS SELECT * FROM one")
    surface = SqlSurface(lake, "mine_")
    with pytest.raises(ForeignTable):
        surface.register()
    land(lake, [mix_payload], [flows_payload], 10)
    transform_silver(lake, 20)
    transform_gold(lake, 30)
    with pytest.raises(ForeignTable):
        surface.register()
    assert spark.table("mine_gold.daily_imports").first().x == 1
    spark.sql("DROP TABLE mine_gold.daily_imports")
    assert len(surface.register()) == 8
    assert surface.bounded("SELECT * FROM mine_gold.daily_imports").count() == 2
    assert surface.sql("SELECT count(*) AS n FROM mine_state.el_state").first().n == 3
