"""Streaming jobs run over everything that is there, read back from their tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.catalog import fixtures as fx
from wattlake.catalog.lake import _SILVER_FLOWS, _SILVER_MIX
from wattlake.catalog.payloads import _EVENTS_SQL, flow_documents, mix_documents
from wattlake.catalog.registry import query
from wattlake.plans.jobs import Lake
from wattlake.schemas import BRONZE, SILVER_FLOWS, SILVER_MIX
from wattlake.session import scratch_path
from wattlake.sources import tables
from wattlake.streaming import jobs


def _thirds(spark, path: str, format: str = "parquet") -> int:
    """Files of a micro-batch if there are to be three."""
    return max(1, -(-len(spark.read.format(format).load(path).inputFiles()) // 3))


def _stream_bronze(spark, documents, lake: Lake, kind: str = "mix") -> str:
    """Documents delivered in two parts, as lines of text files; after each the stream takes what is new."""
    landing, path = scratch_path(spark, "landing"), lake.path("bronze", f"electricity_{kind}")
    half = F.pmod(F.xxhash64("raw_json"), F.lit(2))
    for part in (0, 1):
        documents.where(half == part).select("raw_json").write.mode("append").text(landing)
        payloads = jobs.stream_files(spark, landing, format="text", files_per_batch=_thirds(spark, landing, "text"))
        jobs.land_bronze(
            payloads.select(F.col("value").alias("raw_json")), path, f"{lake.root}/checkpoints/bronze",
            f"electricity-{kind}", process_ts=F.unix_millis(F.current_timestamp()))
    return path


@query(f"""WITH {fx.READINGS_SQL}, {_EVENTS_SQL}
SELECT CASE WHEN cut_off THEN 'unreadable' ELSE zone END AS zone, count(*) AS n_documents,
  sum(CASE WHEN cut_off THEN 0 ELSE n END)::BIGINT AS n_records FROM page GROUP BY 1""")
def stream_bronze(spark, sf_dir):
    """Landing files to the bronze table in several micro-batches."""
    lake = Lake(spark, scratch_path(spark, "lake"))
    bronze = tables.read_table(spark, _stream_bronze(spark, mix_documents(spark, sf_dir), lake), BRONZE)
    return bronze.groupBy(F.coalesce("zone", F.lit("unreadable")).alias("zone")).agg(
        F.count(F.lit(1)).alias("n_documents"), F.sum("record_count").alias("n_records"))


@query(f"""WITH {_SILVER_MIX}, latest AS (SELECT zone, datetime, updated_at, user_id, value FROM rec
  WHERE NOT cut_off AND user_id >= 2
  QUALIFY row_number() OVER (PARTITION BY zone, rec.datetime ORDER BY rec.updated_at DESC) = 1)
SELECT zone, {fx.time_sql('datetime')} AS datetime, {fx.time_sql('updated_at')} AS updated_at,
  CASE WHEN user_id BETWEEN 4 AND 5 THEN NULL ELSE value END AS flow_exports_mw FROM latest""")
def stream_silver_upsert(spark, sf_dir):
    """Bronze stream to the silver table: rows of later micro-batches replace older ones."""
    lake = Lake(spark, scratch_path(spark, "lake"))
    bronze = _stream_bronze(spark, mix_documents(spark, sf_dir), lake)
    path = lake.path("silver", "electricity_mix")
    jobs.stream_silver(
        jobs.stream_files(spark, bronze, BRONZE, files_per_batch=2), "mix", path,
        lake.path("silver", "silver_mix_bad_data"), f"{lake.root}/checkpoints/silver")
    return tables.read_table(spark, path, SILVER_MIX, ["zone", "datetime", "updated_at", "flow_exports_mw"])


@query(f"""WITH {_SILVER_FLOWS}
SELECT zone, {fx.time_sql('datetime')} AS datetime, neighbor_zone, direction, round(power_mw, 6) AS power_mw FROM good""")
def stream_flows_upsert(spark, sf_dir):
    """The stream of exchanges to their silver table."""
    lake = Lake(spark, scratch_path(spark, "lake"))
    bronze = _stream_bronze(spark, flow_documents(spark, sf_dir), lake, "flows")
    path = lake.path("silver", "electricity_flows")
    jobs.stream_silver(
        jobs.stream_files(spark, bronze, BRONZE, files_per_batch=2), "flows", path,
        lake.path("silver", "silver_flows_bad_data"), f"{lake.root}/checkpoints/silver")
    return tables.read_table(spark, path, SILVER_FLOWS, ["zone", "datetime", "neighbor_zone", "direction", "power_mw"])


@query(f"""WITH {fx.READINGS_SQL}
SELECT zone, {fx.time_sql('datetime')} AS datetime, {fx.time_sql('updated_at')} AS updated_at, event_id, source, round(mw, 6) AS mw
FROM readings QUALIFY row_number() OVER (PARTITION BY zone, datetime ORDER BY updated_at DESC, event_id DESC) = 1""")
def stream_latest(spark, sf_dir):
    """The latest reading of every zone and hour, from a stream in which readings come in any order."""
    source, out = scratch_path(spark, "readings"), scratch_path(spark, "latest")
    rows = fx.readings(spark, sf_dir).select("zone", "datetime", "updated_at", "event_id", "source", "mw")
    rows.repartition(6, F.xxhash64("event_id")).write.parquet(source)
    stream = jobs.stream_files(spark, source, rows.schema, files_per_batch=_thirds(spark, source))
    latest = jobs.latest_rows(stream, ["zone", "datetime"], "updated_at", ["updated_at", "event_id"], "60 days")
    jobs.keep_current(latest, out, scratch_path(spark, "checkpoint"), ["zone", "datetime"], "datetime")
    return spark.read.parquet(out).select(*rows.columns)


@query(f"""WITH {fx.READINGS_SQL}
SELECT zone, source, count(*) AS n_rows, round(sum(mw), 6) AS total_mw, max(event_id) AS last_event
FROM readings GROUP BY 1, 2""")
def stream_dedup(spark, sf_dir):
    """A stream in which every row is delivered three times, without the replays."""
    source = scratch_path(spark, "replayed")
    rows = fx.readings(spark, sf_dir)
    for _ in range(3):
        rows.write.mode("append").parquet(source)
    out = scratch_path(spark, "unique")
    stream = jobs.drop_replays(
        jobs.stream_files(spark, source, rows.schema, files_per_batch=_thirds(spark, source)), ["event_id"], "updated_at",
        "60 days")
    jobs.append_parquet(stream, out, scratch_path(spark, "checkpoint"))
    return spark.read.schema(rows.schema).parquet(out).groupBy("zone", "source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("mw").alias("total_mw"), F.max("event_id").alias("last_event"))


_DAILY = f"""WITH {fx.READINGS_SQL}
SELECT zone, {fx.date_sql('datetime')} AS date, round(sum(mw), 6) AS total_mwh, count(*) AS n_rows,
  count(DISTINCT datetime)::INTEGER AS hours_covered
FROM readings GROUP BY zone, {fx.date_sql('datetime')}, datetime::DATE"""


def _daily_stream(spark, sf_dir, delay: str, files_per_batch: int | None):
    """Readings written as files, streamed into daily totals per zone."""
    source = scratch_path(spark, "readings")
    rows = fx.readings(spark, sf_dir)
    rows.write.partitionBy("source").parquet(source)
    return jobs.daily_windows(
        jobs.stream_files(spark, source, rows.schema, files_per_batch=files_per_batch or _thirds(spark, source)),
        ["zone"], "updated_at", delay,
        {"total_mwh": F.sum("mw"), "n_rows": F.count(F.lit(1))})


@query(f"""{_DAILY}
HAVING datetime::DATE + INTERVAL 1 DAY <= (SELECT max(updated_at) FROM readings) - INTERVAL 6 HOUR""")
def stream_daily_closed(spark, sf_dir):
    """Daily totals of the days that are closed six hours after their end, taken in one micro-batch."""
    stream = _daily_stream(spark, sf_dir, "6 hours", 1000)
    out = scratch_path(spark, "daily")
    jobs.append_parquet(stream, out, scratch_path(spark, "checkpoint"))
    return spark.read.schema(stream.schema).parquet(out)


@query(_DAILY)
def stream_daily_current(spark, sf_dir):
    """Daily totals of all days, open ones included, brought up to date by every micro-batch."""
    # files are not in the order of time, so nothing may count as late
    stream = _daily_stream(spark, sf_dir, "60 days", None)
    out = scratch_path(spark, "daily")
    jobs.keep_daily_current(stream, out, scratch_path(spark, "checkpoint"), ["zone"])
    return spark.read.parquet(out).select(*stream.columns)
