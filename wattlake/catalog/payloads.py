"""Raw documents made of all events, landed, flattened and quarantined.

A document holds the readings of one zone within 120 consecutive events, so its size is bounded
whatever the distribution of zones. Some records and documents carry defects:

* users 0 and 1 send an unreadable time, users 2 and 3 no power, users 4 and 5 no ``mix`` or entries at all,
* every document that starts with an event worth less than one is cut off.
"""

from __future__ import annotations

import os
from itertools import islice

from pyspark.sql import functions as F

from wattlake.catalog import fixtures as fx
from wattlake.catalog.registry import query
from wattlake.operators.flatten import bad_rows, flatten_flows, flatten_mix, good_rows
from wattlake.operators.keys import latest_by_key
from wattlake.plans.jobs import Lake, ingest_bronze
from wattlake.schemas import BRONZE, MIX_KEYS, SOURCES
from wattlake.session import scratch_path
from wattlake.sources import tables
from wattlake.sources.files import file_system, iterate_names, list_folders, move
from wattlake.sources.landing import envelope, read_payloads

PAGE = 120


def _iso(column: str):
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _pages(records):
    """Records (``event_id, zone, value, record``) as documents ``zone, page, raw_json``."""
    grouped = records.groupBy("zone", fx.whole_part(F.col("event_id"), PAGE).alias("page")).agg(
        F.array_sort(F.collect_list(F.struct("event_id", "value", "record"))).alias("r"))
    text = F.concat(
        F.lit('{"zone":"'), F.col("zone"), F.lit('","temporalGranularity":"hourly","unit":"MW","data":['),
        F.array_join(F.transform("r", lambda x: x["record"]), ","), F.lit("]}"))
    cut_off = F.col("r")[0]["value"] < 1
    return grouped.select(
        "zone", "page", F.when(cut_off, F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text).alias("raw_json"))


def _record(rows, fields):
    """Records as JSON text; users 0 and 1 get an unreadable time."""
    return F.to_json(F.struct(
        F.when(F.col("user_id") < 2, "no time").otherwise(_iso("hour")).alias("datetime"),
        _iso("ts").alias("updatedAt"), *fields))


def mix_documents(spark, sf_dir):
    rows = tables.spread(fx.events(spark, sf_dir)).withColumns({
        "zone": fx.zone_of(F.col("user_id")), "hour": F.date_trunc("hour", "ts"),
        "source": fx.source_of(F.col("event_type"), F.col("user_id"))})
    power = F.when(~F.col("user_id").between(2, 3), F.col("value"))
    mix = F.when(~F.col("user_id").between(4, 5), F.struct(
        *[F.when(F.col("source") == s, power).alias(s) for s in SOURCES],
        F.struct(F.when(F.col("source") == "hydro", F.col("value")).alias("charge")).alias("hydro storage"),
        F.struct(F.col("value").alias("exports")).alias("flows")))
    estimated = F.col("event_type") == "error"
    record = _record(rows, [
        estimated.alias("isEstimated"), F.when(estimated, "GUESS").alias("estimationMethod"), mix.alias("mix")])
    return _pages(rows.select("event_id", "zone", "value", record.alias("record")))


def flow_documents(spark, sf_dir):
    flows = fx.silver_flows(spark, sf_dir, extra=["user_id", "ts", "value"])
    rows = flows.withColumnRenamed("datetime", "hour")
    # JSON of a map keeps null values out, so the entry is written as text.
    entry = F.concat(F.lit('{"'), F.col("neighbor_zone"), F.lit('":'),
                     F.when(F.col("user_id").between(2, 3), "null").otherwise(F.col("value").cast("string")), F.lit("}"))
    head = _record(rows, [])
    record = F.when(F.col("user_id").between(4, 5), head).otherwise(F.concat(
        F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"'), F.col("direction"), F.lit('":'), entry, F.lit("}")))
    return _pages(rows.select("event_id", "zone", "value", record.alias("record")))


_EVENTS_SQL = f"""raw AS (SELECT e.event_id, e.user_id, e.event_type, e.value, r.zone, r.datetime, r.updated_at, r.source,
    r.event_id // {PAGE} AS page FROM readings r JOIN events e ON e.event_id = r.event_id),
page AS (SELECT zone, page, arg_min(value, event_id) < 1 AS cut_off, count(*) AS n FROM raw GROUP BY 1, 2),
rec AS (SELECT raw.*, cut_off FROM raw JOIN page USING (zone, page))"""

# A record of the mix documents as rows of the mix table (users 4 and 5 have no sources).
_MIX_ROWS = "CASE WHEN user_id BETWEEN 2 AND 5 THEN NULL ELSE value END"


def _stamped(documents):
    return documents.withColumn("process_ts", F.col("page"))


# ---------------------------------------------------------------- landing

def _landed(spark, sf_dir):
    """Mix documents written as lines of text files, in a folder for the zone asked for, read back and put into envelopes."""
    path = scratch_path(spark, "landing")
    mix_documents(spark, sf_dir).select("zone", "raw_json").write.partitionBy("zone").text(path)
    start, end = (F.lit(t).cast("timestamp") for t in ("2024-01-01 00:00:00", "2024-01-31 00:00:00"))
    return envelope(
        read_payloads(spark, path, one_per_line=True), process_ts=7, ingested_at=end + F.expr("INTERVAL 90 MINUTES"),
        base_url="https://api.example.org/v4", endpoint="electricity-mix", start=start, end=end)


@query(f"""WITH {fx.READINGS_SQL}, {_EVENTS_SQL}
SELECT 7::BIGINT AS process_ts, zone, 'https://api.example.org/v4/electricity-mix/past-range?zone=' || zone
    || '&start=2024-01-01T00:00:00+00:00&end=2024-01-31T00:00:00+00:00' AS source_url,
  '2024-01-31 01:30:00.000000' AS ingestion_timestamp, '2024-01-01 00:00:00.000000' AS range_start,
  '2024-01-31 00:00:00.000000' AS range_end, 2024 AS year, 1 AS month, 31 AS day, count(*) AS n_documents,
  sum(CASE WHEN cut_off THEN 0 ELSE n END)::BIGINT AS n_records
FROM page GROUP BY zone""")
def bronze_envelope(spark, sf_dir):
    """Landed documents with lineage columns; a document that cannot be read has no records."""
    return _landed(spark, sf_dir).groupBy(
        "process_ts", "zone", "source_url", "ingestion_timestamp", "range_start", "range_end", "year", "month", "day"
    ).agg(F.count(F.lit(1)).alias("n_documents"), F.sum("record_count").alias("n_records"))


def _write_each(documents, path):
    """A text file for each document, in a folder for its zone. Hadoop starts processes for every file that it makes on a local disk,
    so there Python makes them, by names that a repeated task takes again."""
    place, fs = file_system(documents.sparkSession, path)
    if fs.getScheme() != "file":
        documents.select("zone", "raw_json").write.partitionBy("zone").option("maxRecordsPerFile", 1).text(path)
        return
    fs.mkdirs(place)
    root = place.toUri().getPath()

    def write(batches):
        made = set()
        for batch in batches:
            for zone, page, text in zip(*(column.to_pylist() for column in batch.columns)):
                folder = f"{root}/zone={zone}"
                if folder not in made:
                    os.makedirs(folder, exist_ok=True)
                    made.add(folder)
                with open(f"{folder}/page-{page}.txt", "wb") as file:
                    file.write(f"{text}\n".encode())
        yield from ()

    rows = documents.select(F.coalesce("zone", F.lit("__HIVE_DEFAULT_PARTITION__")), "page", F.coalesce("raw_json", F.lit("")))
    rows.mapInArrow(write, "n INT").write.format("noop").mode("overwrite").save()


@query(f"""WITH {fx.READINGS_SQL}, {_EVENTS_SQL}
SELECT (1 + page % 2)::BIGINT AS process_ts, count(*) AS n_documents, sum(CASE WHEN cut_off THEN 0 ELSE n END)::BIGINT AS n_records,
  count(DISTINCT zone) AS n_zones FROM page GROUP BY 1""")
def landing_twice(spark, sf_dir):
    """A landing folder with a file for each document, half of them there for the first run and half for the second, some with
    names that look like patterns; a third run finds nothing new."""
    lake, path = Lake(spark, scratch_path(spark, "lake")), scratch_path(spark, "files")
    documents = mix_documents(spark, sf_dir)
    none = spark.createDataFrame([], "raw_json string")
    for run in (1, 2, 3):
        if run < 3:
            _write_each(documents.where(F.col("page") % 2 == run - 1), f"{path}/run={run}")
            folders = [f"{path}/run={run}/{zone}" for zone in list_folders(spark, f"{path}/run={run}", 1)]
            files = ((folder, name) for folder in folders for name in iterate_names(spark, folder) if name[0] not in "._")
            for (folder, name), odd in zip(list(islice(files, 4)), ["a[1].json", "b{2,3}.json", "c*.json", "d?x.json"]):
                move(spark, f"{folder}/{name}", f"{folder}/{odd}")
        ingest_bronze(lake, path, none, run)
    rows = tables.read_table(spark, lake.path("bronze", "electricity_mix"), BRONZE)
    zone = F.regexp_extract("raw_json", r'^\{"zone":"([^"]+)"', 1)
    return rows.groupBy("process_ts").agg(
        F.count(F.lit(1)).alias("n_documents"), F.sum("record_count").alias("n_records"), F.count_distinct(zone).alias("n_zones"))


# ---------------------------------------------------------------- flatten

_SOURCE_COLUMNS = ", ".join(f"CASE WHEN source = '{s}' THEN {_MIX_ROWS} END AS {s}_mw" for s in SOURCES)


@query(f"""WITH {fx.READINGS_SQL}, {_EVENTS_SQL}
SELECT zone, {fx.time_sql('datetime')} AS datetime, {fx.time_sql('updated_at')} AS updated_at,
  event_type = 'error' AS is_estimated, CASE WHEN event_type = 'error' THEN 'GUESS' END AS estimation_method,
  {_SOURCE_COLUMNS}, CASE WHEN source = 'hydro' AND user_id NOT BETWEEN 4 AND 5 THEN value END AS hydro_storage_charge_mw,
  NULL::DOUBLE AS hydro_storage_discharge_mw, NULL::DOUBLE AS battery_storage_charge_mw,
  NULL::DOUBLE AS battery_storage_discharge_mw, CASE WHEN user_id NOT BETWEEN 4 AND 5 THEN value END AS flow_exports_mw,
  NULL::DOUBLE AS flow_imports_mw, page::BIGINT AS process_ts, {fx.days_sql('datetime')}
FROM rec WHERE NOT cut_off AND user_id >= 2""")
def flatten_mix_json(spark, sf_dir):
    """Readable mix records as typed rows."""
    return good_rows(flatten_mix(_stamped(mix_documents(spark, sf_dir))))


@query(f"""WITH {fx.READINGS_SQL}, {_EVENTS_SQL}
SELECT page::BIGINT AS process_ts, 'unknown' AS datetime, 'MALFORMED_JSON' AS error_message, count(*) AS n_rows
FROM page WHERE cut_off GROUP BY 1
UNION ALL SELECT page, 'no time', 'BAD_DATETIME', count(*) FROM rec WHERE NOT cut_off AND user_id < 2 GROUP BY 1""")
def flatten_mix_quarantine(spark, sf_dir):
    """Unreadable documents and records by reason."""
    bad = bad_rows(flatten_mix(_stamped(mix_documents(spark, sf_dir))))
    return bad.groupBy("process_ts", "datetime", "error_message").agg(F.count("raw_json").alias("n_rows"))


@query(f"""WITH {fx.READINGS_SQL}, {_EVENTS_SQL}, {fx.FLOWS_SQL}
SELECT rec.zone, {fx.time_sql('rec.datetime')} AS datetime, {fx.time_sql('rec.updated_at')} AS updated_at,
  neighbor_zone, direction, CASE WHEN user_id BETWEEN 2 AND 3 THEN 0 ELSE value END AS power_mw,
  rec.page::BIGINT AS process_ts, {fx.days_sql('rec.datetime')}
FROM rec JOIN flows USING (event_id) WHERE NOT cut_off AND user_id >= 2 AND user_id NOT BETWEEN 4 AND 5""")
def unpivot_flows_json(spark, sf_dir):
    """Import and export entries of flow records as rows."""
    return good_rows(flatten_flows(_stamped(flow_documents(spark, sf_dir))))


@query(f"""WITH {fx.READINGS_SQL}, {_EVENTS_SQL}
SELECT zone, {fx.time_sql('datetime')} AS datetime, {fx.time_sql('updated_at')} AS updated_at, event_type = 'error' AS is_estimated,
  CASE WHEN user_id BETWEEN 4 AND 5 THEN NULL ELSE value END AS flow_exports_mw
FROM rec WHERE NOT cut_off AND user_id >= 2
QUALIFY row_number() OVER (PARTITION BY zone, rec.datetime ORDER BY rec.updated_at DESC) = 1""")
def flatten_and_dedup(spark, sf_dir):
    """Flattened mix records, the latest per zone and hour."""
    rows = good_rows(flatten_mix(_stamped(mix_documents(spark, sf_dir))))
    return latest_by_key(rows, MIX_KEYS, ["updated_at", "process_ts"]).select(
        "zone", "datetime", "updated_at", "is_estimated", "flow_exports_mw")


@query(f"""WITH {fx.READINGS_SQL}, {_EVENTS_SQL}
SELECT error_message, count(*) AS n_rows, sum(n_chars)::BIGINT AS n_chars FROM (
  SELECT 'BAD_DATETIME' AS error_message, length('no time') AS n_chars FROM rec WHERE NOT cut_off AND user_id < 2
  UNION ALL SELECT 'MALFORMED_JSON', length('unknown') FROM page WHERE cut_off) GROUP BY 1""")
def bad_data_append(spark, sf_dir):
    """Quarantined rows appended to their table, which the first append creates, and read back."""
    from wattlake.schemas import BAD_DATA

    path = scratch_path(spark, "bad")
    tables.append_if_any(bad_rows(flatten_mix(_stamped(mix_documents(spark, sf_dir)))), path)
    return tables.read_table(spark, path, BAD_DATA).groupBy("error_message").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("datetime")).alias("n_chars"))
