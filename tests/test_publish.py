"""Stops at every point of a publication, writers side by side, and the ledger as a log of commits."""

import json
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from wattlake import schemas as S
from wattlake.operators.ledger import ClaimConflict, Ledger
from wattlake.plans.jobs import Lake, batches_of, ingest_bronze, transform_gold, transform_silver
from wattlake.sources import publish, tables
from wattlake.sources.commits import CommitLog


class Lost(BaseException):
    """The driver is gone: no handler of the jobs runs for it."""


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def flow_rows(spark, *rows):
    data = [(1, "FR", datetime(2026, 4, d), datetime(2026, 4, d), n, "import", mw, 2026, 4, d) for d, n, mw in rows]
    return spark.createDataFrame(data, S.SILVER_FLOWS)


def content(spark, path):
    return sorted((r.day, r.neighbor_zone, r.power_mw) for r in tables.read_table(spark, path, S.SILVER_FLOWS).collect())


def stop_at(monkeypatch, target, name, call, before=True):
    """Lose the driver at the n-th call, before or after it does its work."""
    original, calls = getattr(target, name), []

    def stopped(*args, **values):
        calls.append(1)
        if len(calls) == call and before:
            raise Lost
        result = original(*args, **values)
        if len(calls) == call:
            raise Lost
        return result

    monkeypatch.setattr(target, name, stopped)


# Where the driver is lost: while staging, at the commit, between two days, before and after the last commit.
STOPS = [(publish.Publication, "replace", 1, True), (publish.Publication, "replace", 1, False), (CommitLog, "add", 1, True),
         (CommitLog, "add", 1, False), (publish, "remove_files", 2, True), (publish, "move", 1, True), (publish, "move", 1, False),
         (publish, "move", 2, True), (publish, "move", 3, False), (CommitLog, "add", 2, True), (CommitLog, "add", 2, False)]


@pytest.mark.parametrize("target, name, call, before", STOPS)
def test_upsert_after_a_stop_equals_an_undisturbed_one(spark, tmp_path, monkeypatch, target, name, call, before):
    path = str(tmp_path / "t")
    tables.append(flow_rows(spark, (1, "DE", 1.0), (2, "DE", 2.0), (2, "BE", 3.0), (3, "ES", 4.0)), path, S.DAY_COLUMNS)
    incoming = flow_rows(spark, (2, "DE", 9.0), (3, "IT", 5.0), (4, "CH", 6.0))
    with monkeypatch.context() as patch:
        stop_at(patch, target, name, call, before)
        with pytest.raises(Lost):
            tables.upsert_by_keys(incoming, path, S.FLOW_KEYS, S.SILVER_FLOWS)
    tables.upsert_by_keys(incoming, path, S.FLOW_KEYS, S.SILVER_FLOWS)
    assert content(spark, path) == [(1, "DE", 1.0), (2, "BE", 3.0), (2, "DE", 9.0), (3, "ES", 4.0), (3, "IT", 5.0), (4, "CH", 6.0)]


@pytest.mark.parametrize("target, name, call, before", [STOPS[4], STOPS[6], STOPS[9]])
def test_days_replaced_by_nothing_after_a_stop(spark, tmp_path, monkeypatch, target, name, call, before):
    path = str(tmp_path / "t")
    tables.append(flow_rows(spark, (1, "DE", 1.0), (2, "DE", 2.0), (3, "DE", 3.0)), path, S.DAY_COLUMNS)
    days = [(2026, 4, 2), (2026, 4, 3)]
    with monkeypatch.context() as patch:
        stop_at(patch, target, name, call, before)
        with pytest.raises(Lost):
            tables.replace_days(flow_rows(spark, (2, "BE", 5.0)), path, days, S.FLOW_KEYS)
    # another writer of other days finishes it first
    tables.upsert_by_keys(flow_rows(spark, (9, "XX", 1.0)), path, S.FLOW_KEYS, S.SILVER_FLOWS)
    assert content(spark, path) == [(1, "DE", 1.0), (2, "BE", 5.0), (9, "XX", 1.0)]


def frame(lake, *payloads):
    return lake.spark.createDataFrame([(p if isinstance(p, str) else json.dumps(p),) for p in payloads], "raw_json string")


def whole(lake):
    """Everything the layers hold, without batch ids and times of quarantine."""
    found = []
    for layer, name, schema in (("silver", "electricity_mix", S.SILVER_MIX), ("silver", "electricity_flows", S.SILVER_FLOWS),
                                ("silver", "silver_mix_bad_data", S.BAD_DATA), ("gold", "daily_electricity_mix", S.GOLD_MIX),
                                ("gold", "daily_imports", S.GOLD_IMPORTS), ("gold", "daily_exports", S.GOLD_EXPORTS)):
        rows = tables.read_table(lake.spark, lake.path(layer, name), schema).drop("process_ts", "created_at").collect()
        found += sorted((name, str(r)) for r in rows)
    return found


@pytest.mark.parametrize("layer, target, name, call, before", [
    ("silver", publish, "move", 1, True), ("silver", publish, "move", 2, True), ("silver", publish, "move", 3, False),
    ("silver", Ledger, "mark_ready", 1, True), ("gold", publish, "move", 2, True), ("gold", publish, "move", 3, False)])
def test_jobs_after_a_stop_equal_undisturbed_ones(spark, tmp_path, mix_payload, flows_payload, monkeypatch, layer, target, name,
                                                 call, before):
    lakes = [Lake(spark, str(tmp_path / n)) for n in ("calm", "stopped")]
    for lake in lakes:
        ingest_bronze(lake, frame(lake, mix_payload, "{ malformed }"), frame(lake, flows_payload), 10)
        if layer == "gold":
            transform_silver(lake, 20)
        job = {"silver": transform_silver, "gold": transform_gold}[layer]
        if lake is lakes[1]:
            with monkeypatch.context() as patch:
                stop_at(patch, target, name, call, before)
                with pytest.raises(Lost):
                    job(lake, 25)
        transform_silver(lake, 30)
        transform_gold(lake, 40)
    assert whole(lakes[0]) == whole(lakes[1]) and len(whole(lakes[0])) == 11
    left = f"{lakes[1].root}/_staged"
    assert not [f for owner in publish.list_names(spark, left) for f in publish.list_names(spark, f"{left}/{owner}")]
    assert transform_silver(lakes[1], 50)["status"] == "no_pending" and transform_gold(lakes[1], 60)["status"] == "no_pending"


def test_bad_rows_of_a_repeated_run_are_there_once(lake, mix_payload, monkeypatch):
    ingest_bronze(lake, frame(lake, "{ malformed }", mix_payload), frame(lake, {"data": []}), 10)
    with monkeypatch.context() as patch:
        stop_at(patch, publish.Publication, "commit", 1, True)
        with pytest.raises(Lost):
            transform_silver(lake, 20)
    assert transform_silver(lake, 30)["bad_mix_records"] == 1
    assert tables.read_table(lake.spark, lake.path("silver", "silver_mix_bad_data"), S.BAD_DATA).count() == 1


# ---------------------------------------------------------------- commits

def test_numbers_are_taken_once(spark, tmp_path):
    logs = [CommitLog(spark, str(tmp_path / "log")) for _ in range(4)]
    with ThreadPoolExecutor(4) as pool:
        taken = list(pool.map(lambda i: (logs[i % 4].add({"by": i}), i), range(60)))
    assert sorted(n for n, _ in taken) == list(range(1, 61))
    assert all(logs[0].read(n) == {"by": i} for n, i in taken)
    assert CommitLog(spark, str(tmp_path / "log")).last() == 60 and CommitLog(spark, str(tmp_path / "none")).last() == 0
    assert [p.name for p in (tmp_path / "log").iterdir() if not p.name.endswith(".json")] == []


def test_of_two_claimers_one_wins(lake):
    for ts in (1, 2, 3):
        lake.ledger.open("bronze", ts)
        lake.ledger.mark_ready("bronze", ts, 1)
    seen = [lake.ledger.pending("bronze", "silver") for _ in range(2)]
    assert seen == [[1, 2, 3], [1, 2, 3]]

    def claim(i):
        try:
            lake.ledger.claim("bronze", seen[i], claimed_by=100 + i)
        except ClaimConflict:
            return None
        return 100 + i

    with ThreadPoolExecutor(2) as pool:
        won = [w for w in pool.map(claim, range(2)) if w]
    assert len(won) == 1
    assert sorted(r.process_ts for r in lake.ledger.claimed("bronze", won[0]).collect()) == [1, 2, 3]
    assert lake.ledger.commits.last() == 7


def test_a_claimer_that_came_second_leaves_the_first_alone(lake, mix_payload, flows_payload, monkeypatch):
    ingest_bronze(lake, frame(lake, mix_payload), frame(lake, flows_payload), 10)
    original = Ledger.claim

    def overtaken(self, process, batches, claimed_by=None):
        if claimed_by == 20:
            self.open("silver", 19)
            original(self, process, batches, claimed_by=19)
        original(self, process, batches, claimed_by=claimed_by)

    monkeypatch.setattr(Ledger, "claim", overtaken)
    with pytest.raises(ClaimConflict):
        transform_silver(lake, 20)
    state = {(r.process, r.process_ts): r.status for r in lake.ledger.state().collect()}
    assert state == {("bronze", 10): "P", ("silver", 19): "I", ("silver", 20): "I"}
    assert [r.process_ts for r in lake.ledger.claimed("bronze", 19).collect()] == [10]
    assert lake.ledger.pending("bronze", "silver", lease=timedelta(hours=1)) == []  # the first may still be at work
    assert lake.ledger.pending("bronze", "silver") == [10]


def test_history_over_checkpoints_and_writers(lake):
    ledger, other = lake.ledger, Ledger(lake.spark, lake.root)
    for i in range(30):
        (ledger if i % 2 else other).release("bronze", [i, i + 1])
        if i in (9, 19):
            ledger.checkpoint()
            other.checkpoint()
    rows = ledger.history().orderBy("seq", "process_ts").collect()
    assert [r.process_ts for r in rows] == [b for i in range(30) for b in (i, i + 1)]
    assert ledger.history().select("seq").distinct().count() == 30
    assert {r.process_ts for r in other.state().collect()} == set(range(31))
    # a checkpoint that was not finished, and one that overlaps another, are no harm
    (lake.spark.range(1).write.parquet(f"{ledger.path}/checkpoints/{1:020d}-{25:020d}-x/state"))
    assert ledger.history().count() == 60


def test_an_unfinished_publication_survives_a_checkpoint(lake):
    path = lake.path("silver", "electricity_flows")
    change = lake.ledger.publication("silver")
    change.replace(flow_rows(lake.spark, (1, "DE", 1.0)), path)
    change.prepare()
    lake.ledger.checkpoint()
    assert Ledger(lake.spark, lake.root).recover("gold") == 0
    assert Ledger(lake.spark, lake.root).recover("silver") == 1
    assert content(lake.spark, path) == [(1, "DE", 1.0)]
    assert lake.ledger.recover("silver") == 0


def test_many_pending_batches_are_a_frame(lake):
    ids = list(range(1, 10_001))
    rows = (lake.spark.range(1, 10_001).select(
        F.col("id").alias("process_ts"), F.lit(None).cast("timestamp").alias("ingestion_timestamp"),
        *[F.lit(None).cast("string").alias(c) for c in ("source_url", "zone")],
        *[F.lit(None).cast("timestamp").alias(c) for c in ("range_start", "range_end")], F.lit("{}").alias("raw_json"),
        F.lit(0).cast("bigint").alias("record_count"), F.lit(2026).alias("year"), F.lit(4).alias("month"),
        (F.col("id") % 20 + 1).cast("int").alias("day")))
    tables.append(rows, lake.path("bronze", "electricity_mix"), S.DAY_COLUMNS)
    for day in range(1, 21):
        lake.ledger.commits.add({"changes": [lake.ledger._change(
            "bronze", [i for i in ids if i % 20 + 1 == day], "R", days=[20260400 + day])]})
    pending = lake.ledger.pending("bronze", "silver")
    assert pending == ids
    lake.ledger.open("silver", 7)
    lake.ledger.claim("bronze", pending[:0] or type(pending)([i for i in pending if i % 20 in (3, 4)], pending.as_of), claimed_by=7)
    scan = batches_of(lake, "bronze", "electricity_mix", S.BRONZE, 7, True)
    assert "dynamicpruning" in scan._jdf.queryExecution().executedPlan().toString()
    assert scan.count() == 1000
    assert sorted(r.process_ts for r in scan.select("process_ts").collect())[:3] == [3, 4, 23]


def test_leases_count_from_the_opening(lake):
    lake.ledger.open("bronze", 1)
    lake.ledger.mark_ready("bronze", 1, 1)
    lake.ledger.open("silver", 5, start=datetime.now(timezone.utc) - timedelta(hours=2))
    lake.ledger.claim("bronze", [1], claimed_by=5)
    assert lake.ledger.pending("bronze", "silver", timedelta(hours=3)) == []
    assert lake.ledger.pending("bronze", "silver", timedelta(hours=1)) == [1]
    lake.ledger.mark_error("silver", 5, "failed")
    assert lake.ledger.pending("bronze", "silver", timedelta(hours=3)) == [1]
