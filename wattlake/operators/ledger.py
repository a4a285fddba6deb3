"""Batch ledger: a log of numbered commits, each some status changes, whose current state is a query.

A commit is a small file that only one writer can create, so the numbers order changes of all writers without a clock. A
claim that another writer's commit came before fails and changes nothing. Every so many commits their rows are put
together as a checkpoint, current state and history, and reading starts from the last one; commits are never deleted.
Publications of tables are commits of the same log.

A batch goes I (started) -> R (ready) -> P (claimed by the next layer) -> C (consumed). A failure
appends I with a message for the failed batch and R for the batches it had claimed, so that a
retry finds them again. A claim names the batch that made it: when that batch never got to R (its driver was
lost), the next run takes the claimed batches back, at once or when a lease has run out; when it did, they are only marked
as consumed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.functions.timecols import floor_to_hour, process_ts_to_timestamp, utc
from wattlake.schemas import LEDGER_LOG, LEDGER_STATE
from wattlake.sources.commits import CommitLog
from wattlake.sources.files import exists, list_names, read_text, write_text
from wattlake.sources.publish import Publication, recover, unfinished
from wattlake.sources.tables import Day, only_batches, union_all

CHECKPOINT_EVERY = 64  # commits; fewer are read one by one

_TIMES = ("start_timestamp", "end_timestamp", "range_end")
_CHANGE = ", ".join(f"{f.name}: {'bigint' if f.name in _TIMES else f.dataType.simpleString()}"
                    for f in LEDGER_LOG.fields if f.name not in ("process_ts", "seq"))
COMMIT = f"changes array<struct<batches: array<bigint>, {_CHANGE}>>"
_PLACES = 1 << 24  # seq is a commit's number times this, plus the place of a change in it


def commit_of(seq: Column) -> Column:
    """The number of the commit that a change belongs to."""
    return F.floor(seq / _PLACES)


def state_sql(commits: str) -> str:
    """The current state as SQL over a table of commits."""
    told = [c for c in LEDGER_STATE.fieldNames() if c not in ("process", "process_ts")]
    last = [f"max_by({c}, CASE WHEN {c} IS NOT NULL THEN seq END) AS {c}" for c in told]
    columns = [f"timestamp_micros(c.{c}) AS {c}" if c in _TIMES else f"c.{c}" for c in told]
    return f"""SELECT {', '.join(LEDGER_STATE.fieldNames())} FROM (
      SELECT process, process_ts, {', '.join(last)} FROM (
        SELECT c.process, explode(c.batches) AS process_ts, number * {_PLACES} + place AS seq, {', '.join(columns)} FROM (
          SELECT CAST(substring_index(_metadata.file_name, '.', 1) AS BIGINT) AS number, posexplode(changes) AS (place, c)
          FROM {commits})) GROUP BY process, process_ts)"""


class ClaimConflict(RuntimeError):
    """Another writer changed a batch after it was seen as pending."""


class Pending(list):
    """Batch ids that were pending after commit ``as_of``."""

    def __init__(self, batches, as_of: int):
        super().__init__(batches)
        self.as_of = as_of

_CARRIED = ["start_timestamp", "end_timestamp", "record_count", "error_message", "range_end", "days", "claimed_by"]


def log_rows(rows: DataFrame, **values: Column) -> DataFrame:
    """A log made of ``rows``: the given columns, and null in every other column of the schema."""
    return rows.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LEDGER_LOG.fields])


def current_state(log: DataFrame) -> DataFrame:
    """One row per batch: its last status and, for every other column, its last non-null value."""
    def last(column: str):
        return F.max_by(column, F.when(F.col(column).isNotNull(), F.col("seq"))).alias(column)

    return log.groupBy("process", "process_ts").agg(
        F.max("seq").alias("seq"), last("status"), *[last(c) for c in _CARRIED])


def ready_batches(log: DataFrame, process: str) -> DataFrame:
    state = current_state(log.where(F.col("process") == process))
    return state.where("status = 'R'").select("process_ts")


def finished_batches(log: DataFrame, process: str) -> DataFrame:
    """Batches that got to ready, whatever became of them since."""
    return current_state(log.where(F.col("process") == process)).where("status IN ('R', 'P', 'C')").select("process_ts")


def orphaned_batches(log: DataFrame, process: str, claimer: str, opened_before: Column | None = None) -> DataFrame:
    """``process_ts, done`` of claimed batches whose claimer, a batch of ``claimer``, is not at work any more: it
    finished without marking them (``done``) or was lost. Which claimers that hold no error and are not finished are lost says
    ``opened_before``: those opened earlier. Without it all are, as with one writer per layer no other claim is alive."""
    state = current_state(log.where(F.col("process") == process)).where("status = 'P' AND claimed_by IS NOT NULL")
    finished = F.col("status").isin("R", "P", "C")
    lost = F.lit(True) if opened_before is None else (
        F.col("error_message").isNotNull() | F.coalesce(F.col("start_timestamp") < opened_before, F.lit(True)))
    claimers = current_state(log.where(F.col("process") == claimer)).select(
        F.col("process_ts").alias("claimed_by"), finished.alias("finished"), (finished | lost).alias("gone"))
    return (state.join(claimers, "claimed_by", "left").where(F.coalesce("gone", F.lit(True)))
            .select("process_ts", F.coalesce("finished", F.lit(False)).alias("done")))


def last_batch(log: DataFrame, process: str) -> DataFrame:
    """The newest batch id of a layer and its time; null where the layer has none."""
    newest = F.max("process_ts")
    return log.where((F.col("process") == process) & F.col("status").isNotNull()).agg(
        newest.alias("process_ts"), process_ts_to_timestamp(newest).alias("batch_time")
    )


def catch_up_window(log: DataFrame, process: str, now, current_batch: int | None = None) -> DataFrame:
    """The hours ``[range_start, range_end)`` the next run has to fetch, as one row.

    It starts where the last finished batch ended (24 hours ago if there is none), ends at the
    current hour, and holds at least one hour. The running batch and failed ones do not count.
    """
    state = current_state(log.where(F.col("process") == process))
    if current_batch is not None:
        state = state.where(F.col("process_ts") != current_batch)
    done = state.where("status IN ('R', 'P', 'C')").agg(
        F.max(F.coalesce("range_end", process_ts_to_timestamp(F.col("process_ts")))).alias("last_end")
    )
    end = floor_to_hour(now)
    start = F.coalesce(floor_to_hour(F.col("last_end")), floor_to_hour(now - F.expr("INTERVAL 24 HOURS")))
    return done.select(
        F.least(start, end - F.expr("INTERVAL 1 HOUR")).alias("range_start"), end.alias("range_end")
    )


def _micros(value: datetime) -> int:
    return round((value.astimezone(timezone.utc) - datetime(1970, 1, 1, tzinfo=timezone.utc)) / timedelta(microseconds=1))


class Ledger:
    """Reads and commits to the ledger below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self.path = f"{root}/state/el_state_log"
        self.commits = CommitLog(spark, f"{self.path}/commits")
        self.staging = f"{root}/_staged"

    # ------------------------------------------------------------ reading

    def _rows(self, first: int, last: int) -> DataFrame:
        """The changes of some commits as rows of the log."""
        files = [self.commits.file_of(n) for n in range(first, last + 1)]
        if not files:
            return self.spark.createDataFrame([], LEDGER_LOG)
        number = F.substring_index(F.col("_metadata.file_name"), ".", 1).cast("bigint")
        changes = self.spark.read.schema(COMMIT).json(files).select(number.alias("number"), F.posexplode("changes").alias("place", "c"))
        rows = changes.select((F.col("number") * _PLACES + F.col("place")).alias("seq"), "c.*", F.explode("c.batches").alias("process_ts"))
        times = {c: F.timestamp_micros(c) for c in _TIMES}
        return rows.withColumns(times).select(*[F.col(f.name).cast(f.dataType) for f in LEDGER_LOG.fields])

    def _checkpoints(self) -> list[tuple[int, int, str]]:
        """(first commit, last commit, folder) of every whole checkpoint."""
        found = []
        for name in list_names(self.spark, f"{self.path}/checkpoints"):
            folder = f"{self.path}/checkpoints/{name}"
            if exists(self.spark, f"{folder}/open.json"):  # written last
                first, last, _ = name.split("-")
                found.append((int(first), int(last), folder))
        return sorted(found)

    def _newest(self) -> tuple[int, str | None]:
        """(last commit, folder) of the checkpoint that reaches furthest."""
        return max(((last, folder) for _, last, folder in self._checkpoints()), default=(0, None))

    def log(self, upto: int | None = None) -> DataFrame:
        """Rows that say the same of the current state as all changes: the last checkpoint's state, and the changes since."""
        done, folder = self._newest()
        recent = self._rows(done + 1, self.commits.last() if upto is None else upto)
        return recent if folder is None else self.spark.read.schema(LEDGER_LOG).parquet(f"{folder}/state").unionByName(recent)

    def history(self) -> DataFrame:
        """Every change ever made."""
        parts, done = [], 0
        for first, last, folder in sorted(self._checkpoints(), key=lambda c: (c[0], -c[1])):
            if first <= done + 1 <= last:
                rows = self.spark.read.schema(LEDGER_LOG).parquet(f"{folder}/history")
                parts.append(rows.where(F.col("seq") >= (done + 1) * _PLACES))
                done = last
        return union_all([*parts, self._rows(done + 1, self.commits.last())])

    def state(self) -> DataFrame:
        return current_state(self.log()).select(*LEDGER_STATE.fieldNames())

    def uncollected(self) -> int:
        """Commits that no checkpoint holds."""
        return self.commits.last() - self._newest()[0]

    def checkpoint(self) -> None:
        """Put the commits since the last checkpoint together. Seen by readers when whole; stopping in between, or two
        writers at once, do no harm."""
        done, _ = self._newest()
        last = self.commits.last()
        if last == done:
            return
        folder = f"{self.path}/checkpoints/{done + 1:020d}-{last:020d}-{uuid.uuid4().hex}"
        current_state(self.log(last)).select(*LEDGER_LOG.fieldNames()).write.parquet(f"{folder}/state")
        self._rows(done + 1, last).write.parquet(f"{folder}/history")
        write_text(self.spark, f"{folder}/open.json", json.dumps(self._unfinished()))

    # ------------------------------------------------------------ writing

    def _change(self, process: str, batches: Sequence[int], status: str, **values) -> dict:
        told = {k: _micros(v) if isinstance(v, datetime) else v for k, v in values.items() if v is not None}
        return {"process": process, "batches": [int(b) for b in batches], "status": status, **told}

    def _append(self, process: str, batches: Sequence[int], status: str, **values) -> None:
        if batches:
            self.commits.add({"changes": [self._change(process, batches, status, **values)]})

    def open(self, process: str, process_ts: int, start: datetime | None = None) -> None:
        self._append(process, [process_ts], "I", start_timestamp=start or datetime.now(timezone.utc))

    def mark_ready(self, process: str, process_ts: int, record_count: int,
                   end: datetime | None = None, range_end: datetime | None = None,
                   days: Sequence[Day] | None = None, publication: Publication | None = None) -> None:
        """``days`` are the partitions the batch wrote, so that its readers need not look for them. The batch becomes ready
        together with its ``publication``, which is committed here: there is no state with one and not the other."""
        numbers = None if days is None else [y * 10000 + m * 100 + d for y, m, d in days]
        change = self._change(process, [process_ts], "R", record_count=record_count, range_end=range_end,
                              end_timestamp=end or datetime.now(timezone.utc), days=numbers)
        if publication:
            publication.commit([change])
        else:
            self.commits.add({"changes": [change]})

    def pending(self, process: str, claimer: str | None = None, lease: timedelta | None = None) -> Pending:
        """Ids of the batches to work on: those ready, and those a lost batch of ``claimer`` had claimed. Claims that a
        finished batch left open are closed. One id per pending batch, not per row. With several writers, ``lease`` is the
        time after which a batch of ``claimer`` that has not finished counts as lost."""
        if self.uncollected() >= CHECKPOINT_EVERY:
            self.checkpoint()
        as_of = self.commits.last()
        log = self.log(as_of)
        waiting = {r.process_ts for r in ready_batches(log, process).collect()}
        if claimer is not None:
            before = None if lease is None else utc(datetime.now(timezone.utc) - lease)
            orphans = orphaned_batches(log, process, claimer, before).collect()
            self.mark_complete(process, sorted(r.process_ts for r in orphans if r.done))
            waiting |= {r.process_ts for r in orphans if not r.done}
        return Pending(sorted(waiting), as_of)

    def claim(self, process: str, batches: Sequence[int], claimed_by: int | None = None) -> None:
        """Mark batches as claimed. Raises when another writer has changed one of them since they were seen as pending."""
        if not batches:
            return
        wanted, seen = set(batches), batches.as_of if isinstance(batches, Pending) else self.commits.last()

        def allowed(last: int) -> None:
            for number in range(seen + 1, last + 1):
                for change in self.commits.read(number).get("changes", []):
                    if change["process"] == process and wanted & set(change["batches"]):
                        raise ClaimConflict(f"{process} batches were changed by commit {number}")

        self.commits.add({"changes": [self._change(process, batches, "P", claimed_by=claimed_by)]}, allowed)

    def claim_ready(self, process: str) -> list[int]:
        """Ids of all ready batches, now marked as claimed."""
        claimed = self.pending(process)
        self.claim(process, claimed)
        return list(claimed)

    def claimed(self, process: str, claimed_by: int) -> DataFrame:
        """``process_ts, days`` of the batches that a batch holds: a frame to join scans with."""
        state = current_state(self.log().where(F.col("process") == process))
        return state.where((F.col("status") == "P") & (F.col("claimed_by") == claimed_by)).select("process_ts", "days")

    def days_of(self, process: str, batches: Sequence[int]) -> list[Day] | None:
        """All days the batches wrote; None if any batch did not say."""
        state = current_state(only_batches(self.log().where(F.col("process") == process), batches))
        found = state.agg(
            F.count_if(F.col("days").isNull()).alias("unknown"),
            F.array_distinct(F.flatten(F.collect_set("days"))).alias("days"),
        ).first()
        if found.unknown:
            return None
        return sorted((n // 10000, n // 100 % 100, n % 100) for n in found.days)

    def release(self, process: str, batches: Sequence[int]) -> None:
        self._append(process, batches, "R")

    def mark_complete(self, process: str, batches: Sequence[int]) -> None:
        self._append(process, batches, "C")

    def mark_error(self, process: str, process_ts: int, message: str) -> None:
        self._append(process, [process_ts], "I", error_message=message)

    def last_process_ts(self, process: str) -> datetime | None:
        newest = last_batch(self.log(), process).first().process_ts
        return None if newest is None else datetime.fromtimestamp(newest / 1000, timezone.utc)

    def next_window(self, process: str, current_batch: int | None = None,
                    now: datetime | None = None) -> tuple[datetime, datetime]:
        """The catch-up window as UTC datetimes."""
        now_column = F.current_timestamp() if now is None else utc(now)
        window = catch_up_window(self.log(), process, now_column, current_batch)
        row = window.select(F.unix_seconds("range_start").alias("a"), F.unix_seconds("range_end").alias("b")).first()
        return (datetime.fromtimestamp(row.a, timezone.utc), datetime.fromtimestamp(row.b, timezone.utc))

    # ------------------------------------------------------------ publications

    def publication(self, owner: str) -> Publication:
        """A change of the lake's tables, staged beside them and committed to this log."""
        return Publication(self.spark, self.commits, self.staging, owner)

    def _unfinished(self) -> list[dict]:
        done, folder = self._newest()
        known = json.loads(read_text(self.spark, f"{folder}/open.json")) if folder else []
        return unfinished(self.commits, done, known)

    def recover(self, owner: str) -> int:
        """Finish what a lost run of a layer had committed to publish."""
        done, folder = self._newest()
        known = json.loads(read_text(self.spark, f"{folder}/open.json")) if folder else []
        return recover(self.spark, self.commits, self.staging, owner, done, known)
