"""Streaming forms of the layers. Checkpoints take the place of claiming batches in the ledger."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from wattlake import schemas as S
from wattlake.functions.timecols import day_columns
from wattlake.operators.keys import latest_by_key
from wattlake.plans.jobs import DEFAULT_URL, SILVER_TABLES, clean_rows
from wattlake.session import STATE_STORE
from wattlake.sources import tables
from wattlake.sources.landing import envelope


def stream_files(spark: SparkSession, path: str, schema=None, format: str = "parquet",
                 files_per_batch: int = 1000, **options) -> DataFrame:
    reader = spark.readStream.format(format).option("maxFilesPerTrigger", files_per_batch).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def run_available(query_writer) -> StreamingQuery:
    """Process what is there, in as many micro-batches as needed, and stop."""
    query = query_writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def land_bronze(payloads: DataFrame, path: str, checkpoint: str, endpoint: str,
                process_ts: int | Column, base_url: str = DEFAULT_URL) -> StreamingQuery:
    """Landing files to a bronze table, exactly once. ``payloads`` is a stream with ``raw_json``."""
    hour = F.date_trunc("hour", F.current_timestamp())
    rows = envelope(
        payloads, process_ts=process_ts, ingested_at=F.current_timestamp(), base_url=base_url,
        endpoint=endpoint, start=hour - F.expr("INTERVAL 1 HOUR"), end=hour,
    )
    return run_available(
        rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .partitionBy(*S.DAY_COLUMNS)
    )


def stream_silver(bronze: DataFrame, name: str, path: str, bad_path: str, checkpoint: str,
                  keep: str = "latest", then: Callable[[list[tables.Day]], None] | None = None) -> StreamingQuery:
    """Bronze stream to a silver table by upsert; ``name`` is ``mix`` or ``flows``.

    Every micro-batch stages its clean rows beside the checkpoint. When all are done, the staged rows are upserted as one, later
    micro-batches over earlier ones, so each touched day is written once, however many micro-batches there are. What a run
    that stopped has staged is upserted by the next one. ``then`` is called with the days changed, for example to publish them.

    Repeating a micro-batch after a failure replaces its staged rows by the same rows. Quarantined
    rows go to a folder per micro-batch, which a repeated batch overwrites.
    """
    table, staged = SILVER_TABLES[name], f"{checkpoint}-staged"

    def write(batch: DataFrame, batch_id: int) -> None:
        with tables.persisted(table.flatten(batch)) as (flat,):
            good, bad = clean_rows(flat, table)
            good.write.mode("overwrite").parquet(f"{staged}/batch={batch_id}")
            with tables.persisted(bad) as (bad,):
                if not bad.isEmpty():
                    bad.write.mode("overwrite").parquet(f"{bad_path}/batch={batch_id}")

    query = run_available(bronze.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint))
    days = upsert_staged(bronze.sparkSession, staged, table, path, keep)
    if then is not None and days is not None:
        then(days)
    if days is not None:
        tables.remove_files(bronze.sparkSession, [staged])
    return query


def upsert_staged(spark: SparkSession, staged: str, table, path: str, keep: str) -> list[tables.Day] | None:
    """Upsert the rows that micro-batches have staged, the last one of each key; returns the days changed, or none if no
    micro-batch has staged anything."""
    if not tables.table_exists(spark, staged):
        return None
    schema = T.StructType([*table.schema.fields, T.StructField("batch", T.LongType())])
    rows = spark.read.schema(schema).parquet(staged)
    order = ["updated_at", "batch"] if keep == "latest" else ["batch"]
    rows = latest_by_key(rows, table.keys, order).select(*table.schema.fieldNames())
    return tables.upsert_by_keys(rows, path, table.keys, table.schema, keep, known_unique=True)


def drop_replays(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """Removes exact replays that arrive within ``delay``. The first copy is kept, not the latest."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


class _Latest(StatefulProcessor):
    """Keeps one row per key, the one that comes last in the given order, and forgets it some time after its event time.
    Times are numbers of microseconds here."""

    def __init__(self, columns: list[str], order: list[str], event_time: str, kept_ms: int, schema: T.StructType):
        self.columns, self.order, self.event_time = columns, order, event_time
        self.kept_ms, self.schema = kept_ms, schema

    def init(self, handle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", self.schema)

    def _rank(self, row: tuple) -> tuple:
        """Its place in the order: a missing value comes first, and equal rows are told apart by their content."""
        values = dict(zip(self.columns, row, strict=True))
        return (*[(values[c] is not None, 0 if values[c] is None else values[c]) for c in self.order], repr(row))

    def handleInputRows(self, key, rows, timerValues):
        before = tuple(self.latest.get()) if self.latest.exists() else None
        best = max(filter(None, [before, max((tuple(r[c] for c in self.columns) for r in rows), key=self._rank)]), key=self._rank)
        if best != before:
            self.latest.update(best)
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            at = best[self.columns.index(self.event_time)]
            self.handle.registerTimer(max(at // 1000 + self.kept_ms, timerValues.getCurrentWatermarkInMs() + 1))
            yield Row(**dict(zip(self.columns, best, strict=True)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.latest.clear()
        return iter(())

    def close(self) -> None:
        pass


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """The state store that ``latest_rows`` needs, for the streams started inside."""
    key, before = "spark.sql.streaming.stateStore.providerClass", spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set(key, STATE_STORE)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def latest_rows(stream: DataFrame, keys: list[str], event_time: str, order: list[str], delay: str) -> DataFrame:
    """The latest row of each key as it stands: a row is given when it replaces the one before, whatever order rows come in.

    A key's row is forgotten when the watermark, ``delay`` behind the newest event, has passed the row's ``event_time`` by as
    much again; a still older row that comes then counts as new. Rows without an event time are left out. One row is kept
    for a key, however many come. Start the stream inside ``state_on_disk``."""
    spark, times = stream.sparkSession, [f.name for f in stream.schema.fields if isinstance(f.dataType, T.TimestampType)]
    kept_ms = spark.sql(f"SELECT unix_millis(timestamp'1970-01-01 00:00:00Z' + INTERVAL {delay}) AS ms").first().ms
    numbers = stream.where(F.col(event_time).isNotNull()).withColumn("__time", F.col(event_time)).withWatermark("__time", delay)
    numbers = numbers.withColumns({c: F.unix_micros(c) for c in times})
    schema = numbers.drop("__time").schema
    processor = _Latest(stream.columns, order, event_time, kept_ms, schema)
    latest = numbers.groupBy(*keys).transformWithState(
        statefulProcessor=processor, outputStructType=schema, outputMode="Update", timeMode="EventTime")
    return latest.withColumns({c: F.timestamp_micros(c) for c in times})


def keep_current(rows: DataFrame, path: str, checkpoint: str, keys: list[str], day: str) -> StreamingQuery:
    """A table of the rows that ``latest_rows`` gives, by key, partitioned by the day of the key column ``day``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        found = batch.withColumns(day_columns(F.col(day))).persist()
        try:
            tables.upsert_by_keys(found, path, keys, found.schema, known_unique=True)
        finally:
            found.unpersist()

    with state_on_disk(rows.sparkSession):
        return run_available(rows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint))


def daily_windows(stream: DataFrame, keys: list[str], event_time: str, delay: str,
                  measures: dict[str, Column]) -> DataFrame:
    """Daily tumbling aggregate. In append mode a day is published once its watermark has passed.

    Distinct hours are counted with a bit per hour, since streams have no exact distinct count.
    """
    hours = F.bit_count(F.bit_or(F.call_function("shiftleft", F.lit(1), F.hour(event_time)))).cast("int")
    return (
        stream.withWatermark(event_time, delay)
        .groupBy(F.window(event_time, "1 day"), *keys)
        .agg(*[c.alias(n) for n, c in measures.items()], hours.alias("hours_covered"))
        .select(*keys, F.to_date("window.start").alias("date"), *measures, "hours_covered")
    )


def append_parquet(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return run_available(
        stream.writeStream.outputMode("append").format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def keep_daily_current(daily: DataFrame, path: str, checkpoint: str, keys: list[str]) -> StreamingQuery:
    """Days as they stand, open ones included: every micro-batch upserts the rows it changed.

    ``daily`` is a ``daily_windows`` stream; the table is partitioned by day and keyed by ``keys`` and date.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumns(day_columns(F.col("date"))).persist()
        try:
            tables.upsert_by_keys(rows, path, [*keys, "date"], rows.schema, known_unique=True)
        finally:
            rows.unpersist()

    return run_available(
        daily.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint))
