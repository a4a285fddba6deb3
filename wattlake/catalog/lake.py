"""Write modes, scans of written tables, and the three jobs end to end."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from wattlake.catalog import fixtures as fx
from wattlake.catalog.payloads import _EVENTS_SQL, flow_documents, mix_documents
from wattlake.catalog.registry import query
from wattlake.operators import products
from wattlake.operators.keys import latest_by_key
from wattlake.operators.ledger import CHECKPOINT_EVERY, commit_of
from wattlake.plans.jobs import Lake, ingest_bronze, transform_gold, transform_silver
from wattlake.plans.sql_surface import SqlSurface
from wattlake.schemas import (
    DAY_COLUMNS, FLOW_KEYS, GOLD_EXPORTS, GOLD_IMPORTS, GOLD_MIX, GOLD_MIX_KEYS, SILVER_FLOWS, SOURCES,
)
from wattlake.session import scratch_path
from wattlake.sources import tables
from wattlake.sources.publish import move_part

_TABLE_COLUMNS = SILVER_FLOWS.fieldNames()
_FLOW_OUT = f"""process_ts, zone, {fx.time_sql('datetime')} AS datetime, {fx.time_sql('updated_at')} AS updated_at,
  neighbor_zone, direction, round(power_mw, 6) AS power_mw, {fx.days_sql('datetime')}"""


def _daily_flows(spark, sf_dir):
    """Flows with day timestamps, one row per key."""
    rows = fx.silver_flows(spark, sf_dir, hourly=False)
    return latest_by_key(rows, FLOW_KEYS, ["updated_at", "event_id"])


# The table holds the days to the 20th; the incoming batch brings those from the 11th on. Rows in both
# come with a revised value, and with a newer time of update on one half of the keys only.
_LAST_OLD, _FIRST_NEW = "2024-01-20", "2024-01-11"
_PAIR_SQL = f"""{fx.FLOWS_SQL},
latest AS (SELECT * EXCLUDE (datetime) RENAME (daytime AS datetime) FROM flows
  QUALIFY row_number() OVER (PARTITION BY zone, daytime, neighbor_zone, direction
                             ORDER BY updated_at DESC, event_id DESC) = 1),
old AS (SELECT * FROM latest WHERE datetime <= TIMESTAMP '{_LAST_OLD}'),
incoming AS (SELECT * REPLACE (power_mw + 1000 AS power_mw,
    CASE WHEN direction = 'import' THEN updated_at + INTERVAL 1 DAY ELSE updated_at - INTERVAL 1 DAY END AS updated_at)
  FROM latest WHERE datetime >= TIMESTAMP '{_FIRST_NEW}')"""


def _pair(spark, sf_dir):
    latest = _daily_flows(spark, sf_dir).select(*_TABLE_COLUMNS)
    old = latest.where(F.col("datetime") <= F.lit(_LAST_OLD).cast("timestamp"))
    day = F.expr("INTERVAL 1 DAY")
    incoming = latest.where(F.col("datetime") >= F.lit(_FIRST_NEW).cast("timestamp")).withColumns({
        "power_mw": F.col("power_mw") + 1000,
        "updated_at": F.when(F.col("direction") == "import", F.col("updated_at") + day).otherwise(F.col("updated_at") - day),
    })
    return old, incoming


def _upsert(spark, sf_dir, keep):
    old, incoming = _pair(spark, sf_dir)
    path = scratch_path(spark, "upsert")
    tables.append(old, path, DAY_COLUMNS)
    tables.upsert_by_keys(incoming, path, FLOW_KEYS, SILVER_FLOWS, keep)
    return tables.read_table(spark, path, SILVER_FLOWS)


_UPSERTED = f"""WITH {_PAIR_SQL}, merged AS (SELECT * FROM incoming UNION ALL
  SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.zone = old.zone AND i.datetime = old.datetime
    AND i.neighbor_zone = old.neighbor_zone AND i.direction = old.direction))
SELECT {_FLOW_OUT} FROM merged"""


@query(_UPSERTED)
def upsert_by_key(spark, sf_dir):
    """Incoming rows replace table rows of the same key."""
    return _upsert(spark, sf_dir, "incoming")


@query(_UPSERTED)
def upsert_after_stop(spark, sf_dir):
    """An upsert whose driver is lost when it has published three of its days. The next writer publishes the others, and
    does the lost one's work again, which changes nothing."""
    old, incoming = _pair(spark, sf_dir)
    path = scratch_path(spark, "stopped")
    tables.append(old, path, DAY_COLUMNS)
    lost = tables.own_publication(spark, path)
    tables.upsert_by_keys(incoming, path, FLOW_KEYS, SILVER_FLOWS, publication=lost)
    change = lost.prepare()["moves"][0]
    for part in change["parts"][:3]:
        move_part(spark, change, part)
    tables.upsert_by_keys(incoming, path, FLOW_KEYS, SILVER_FLOWS)
    return tables.read_table(spark, path, SILVER_FLOWS)


@query(f"""WITH {_PAIR_SQL}, merged AS (SELECT * FROM (SELECT *, 1 AS side FROM incoming UNION ALL SELECT *, 0 FROM old)
  QUALIFY row_number() OVER (PARTITION BY zone, datetime, neighbor_zone, direction
                             ORDER BY updated_at DESC, side DESC) = 1)
SELECT {_FLOW_OUT} FROM merged""")
def upsert_keep_latest(spark, sf_dir):
    """Of table and incoming rows the newer one stays."""
    return _upsert(spark, sf_dir, "latest")


# ---------------------------------------------------------------- day replacement

# Recomputed days: the 10th to the 15th with doubled power, and the 16th without any row left.
_RECOMPUTED = f"""WITH {fx.READINGS_SQL}, {fx.wide_sql('readings')}, {fx.daily_mix_sql('wide')},
twice AS (SELECT * REPLACE ({', '.join(f'2 * {s}_mw AS {s}_mw' for s in SOURCES)}) FROM wide
  WHERE datetime >= TIMESTAMP '2024-01-10' AND datetime < TIMESTAMP '2024-01-16'),
{fx.daily_mix_sql('twice', 'renewed')}"""
_RENEWED_DAYS = [(2024, 1, d) for d in range(10, 17)]


def _replaced(spark, sf_dir):
    rows = fx.silver_mix(spark, sf_dir)
    path = scratch_path(spark, "days")
    tables.append(products.daily_mix(rows, 1), path, DAY_COLUMNS)
    changed = rows.where(
        (F.col("datetime") >= F.lit("2024-01-10").cast("timestamp")) & (F.col("datetime") < F.lit("2024-01-16").cast("timestamp"))
    ).withColumns({f"{s}_mw": F.col(f"{s}_mw") * 2 for s in SOURCES})
    tables.replace_days(products.daily_mix(changed, 2), path, _RENEWED_DAYS, GOLD_MIX_KEYS)
    return tables.read_table(spark, path, GOLD_MIX)


@query(_RECOMPUTED + f"""
SELECT {fx.gold_mix_columns_sql('1')} FROM gold WHERE date NOT BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'
UNION ALL SELECT {fx.gold_mix_columns_sql('2')} FROM renewed""")
def replace_affected_days(spark, sf_dir):
    """Recomputed days replace those of the table; the other days are not touched."""
    return _replaced(spark, sf_dir)


@query(f"""WITH {fx.READINGS_SQL}
SELECT zone, {fx.date_sql('datetime')} AS date FROM readings WHERE datetime < TIMESTAMP '2024-01-20' GROUP BY 1, 2""")
def replace_days_empty(spark, sf_dir):
    """Days recomputed to nothing disappear from the table."""
    path = scratch_path(spark, "empty")
    daily = products.daily_mix(fx.silver_mix(spark, sf_dir), 1)
    tables.append(daily, path, DAY_COLUMNS)
    tables.replace_days(daily.limit(0), path, [(2024, 1, d) for d in range(20, 32)], GOLD_MIX_KEYS)
    return tables.read_table(spark, path, GOLD_MIX, ["zone", "date"])


# ---------------------------------------------------------------- scans

@query(f"""WITH {fx.FLOWS_SQL}
SELECT zone, {fx.days_sql('datetime')}, count(*) AS n_rows, round(sum(power_mw), 6) AS total_mw FROM flows
WHERE datetime::DATE IN (DATE '2024-01-05', DATE '2024-01-17', DATE '2024-01-30') GROUP BY ALL""")
def partition_pruned_scan(spark, sf_dir):
    """A set of days read from a table partitioned by day: the other folders are not opened."""
    path = scratch_path(spark, "pruned")
    tables.append(fx.silver_flows(spark, sf_dir).select(*_TABLE_COLUMNS), path, DAY_COLUMNS)
    rows = tables.read_days(spark, path, SILVER_FLOWS, [(2024, 1, 5), (2024, 1, 17), (2024, 1, 30)])
    return rows.groupBy("zone", *DAY_COLUMNS).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("power_mw").alias("total_mw"))


@query("SELECT 'missing' AS part, 0::BIGINT AS n_rows UNION ALL SELECT 'present', count(*) FROM events")
def missing_table_is_empty(spark, sf_dir):
    """A table that does not exist yet reads as one without rows."""
    path = scratch_path(spark, "none")
    flows = fx.silver_flows(spark, sf_dir).select(*_TABLE_COLUMNS)
    before = tables.read_table(spark, path, SILVER_FLOWS)
    tables.append(flows, path, DAY_COLUMNS)
    after = tables.read_table(spark, path, SILVER_FLOWS)
    counts = [df.agg(F.lit(part).alias("part"), F.count(F.lit(1)).alias("n_rows"))
              for part, df in (("missing", before), ("present", after))]
    return tables.union_all(counts)


@query(f"""WITH {fx.READINGS_SQL} SELECT event_id, zone, source, mw FROM readings ORDER BY event_id LIMIT 5""")
def table_preview(spark, sf_dir):
    return tables.preview(fx.readings(spark, sf_dir).select("event_id", "zone", "source", "mw").orderBy("event_id"))


@query(f"""WITH {fx.FLOWS_SQL}
SELECT direction, count(*) AS n_rows, count(DISTINCT neighbor_zone) AS n_neighbors, round(sum(power_mw), 6) AS total_mw
FROM flows GROUP BY 1""")
def batch_extract_roundtrip(spark, sf_dir):
    """A batch written as a Parquet extract and read back."""
    flows = fx.silver_flows(spark, sf_dir).select(*_TABLE_COLUMNS)
    path = tables.write_extract(flows, scratch_path(spark, "extract"), "silver", "electricity_flows", 1706659200000)
    return spark.read.parquet(path).groupBy("direction").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("neighbor_zone").alias("n_neighbors"),
        F.sum("power_mw").alias("total_mw"))


# ---------------------------------------------------------------- the jobs

_SILVER_MIX = f"""{fx.READINGS_SQL}, {_EVENTS_SQL},
good AS (SELECT zone, datetime, source, CASE WHEN user_id BETWEEN 2 AND 5 THEN NULL ELSE value END AS mw
  FROM rec WHERE NOT cut_off AND user_id >= 2
  QUALIFY row_number() OVER (PARTITION BY zone, rec.datetime ORDER BY rec.updated_at DESC) = 1)"""
_GOOD_FLOWS = """(SELECT rec.zone, rec.datetime, neighbor_zone, direction,
    CASE WHEN user_id BETWEEN 2 AND 3 THEN 0 ELSE value END AS power_mw
  FROM rec JOIN flows USING (event_id) WHERE NOT cut_off AND user_id >= 2 AND user_id NOT BETWEEN 4 AND 5
  QUALIFY row_number() OVER (PARTITION BY rec.zone, rec.datetime, neighbor_zone, direction
                             ORDER BY rec.updated_at DESC) = 1)"""
_SILVER_FLOWS = f"{fx.READINGS_SQL}, {_EVENTS_SQL}, {fx.FLOWS_SQL}, good AS {_GOOD_FLOWS}"


def run_jobs(spark, sf_dir) -> Lake:
    """Bronze, silver and gold over all documents in a fresh lake."""
    lake = Lake(spark, scratch_path(spark, "lake"))
    documents = {
        "mix": mix_documents(spark, sf_dir).select("raw_json"),
        "flows": flow_documents(spark, sf_dir).select("raw_json"),
    }
    ingest_bronze(lake, documents["mix"], documents["flows"], 1)
    transform_silver(lake, 2)
    transform_gold(lake, 3)
    return lake


@query(f"""WITH {_SILVER_MIX}, {fx.wide_sql('good')}, {fx.daily_mix_sql('wide')}
SELECT {fx.gold_mix_columns_sql('3')} FROM gold""")
def medallion_end_to_end(spark, sf_dir):
    """Raw documents to the daily mix through all three jobs."""
    return tables.read_table(spark, run_jobs(spark, sf_dir).path("gold", "daily_electricity_mix"), GOLD_MIX)


@query(f"""WITH {_SILVER_FLOWS}, {fx.net_flows_sql('good')}
SELECT 'import' AS product, {fx.exchange_columns_sql('other_zone', 'mwh', 'net_flow', '3')} FROM net WHERE net_flow > 0
UNION ALL
SELECT 'export', {fx.exchange_columns_sql('other_zone', 'mwh', '-net_flow', '3')} FROM net WHERE net_flow < 0""")
def medallion_exchanges(spark, sf_dir):
    """Raw documents to net imports and exports through all three jobs."""
    lake = run_jobs(spark, sf_dir)
    frames = []
    for product, name, schema, other in (
        ("import", "daily_imports", GOLD_IMPORTS, "source_zone"), ("export", "daily_exports", GOLD_EXPORTS, "destination_zone"),
    ):
        df = tables.read_table(spark, lake.path("gold", name), schema)
        frames.append(df.withColumnsRenamed({
            other: "other_zone", f"{other}_name": "other_zone_name", f"{product}_mwh": "mwh",
        }).withColumn("product", F.lit(product)))
    return tables.union_all(frames)


@query(f"""WITH {_SILVER_MIX}, {fx.wide_sql('good')}, {fx.daily_mix_sql('wide')},
{fx.FLOWS_SQL}, good_flows AS {_GOOD_FLOWS}, {fx.net_flows_sql('good_flows')}
SELECT 'bronze' AS process, 1::BIGINT AS process_ts, 'C' AS status,
  (2 * sum(CASE WHEN cut_off THEN 0 ELSE n END))::BIGINT AS record_count FROM page
UNION ALL SELECT 'silver', 2, 'C', (SELECT count(*) FROM good) + (SELECT count(*) FROM good_flows)
UNION ALL SELECT 'gold', 3, 'R', (SELECT count(*) FROM gold) + (SELECT count(*) FROM net WHERE net_flow <> 0)""")
def ledger_after_jobs(spark, sf_dir):
    """What the ledger says after all three jobs: every batch consumed but the last, with its size."""
    return run_jobs(spark, sf_dir).ledger.state().select("process", "process_ts", "status", "record_count")


@query(f"""WITH {_SILVER_MIX}, {fx.wide_sql('good')}, {fx.daily_mix_sql('wide')},
{fx.FLOWS_SQL}, good_flows AS {_GOOD_FLOWS}, {fx.net_flows_sql('good_flows')}
SELECT 'bronze' AS process, 1::BIGINT AS process_ts, 'C' AS status,
  (2 * sum(CASE WHEN cut_off THEN 0 ELSE n END))::BIGINT AS record_count FROM page
UNION ALL SELECT 'silver', 2, 'I', NULL
UNION ALL SELECT 'silver', 3, 'C', (SELECT count(*) FROM good) + (SELECT count(*) FROM good_flows)
UNION ALL SELECT 'gold', 4, 'I', NULL
UNION ALL SELECT 'gold', 5, 'R', (SELECT count(*) FROM gold) + (SELECT count(*) FROM net WHERE net_flow <> 0)""")
def ledger_after_failure(spark, sf_dir):
    """A silver run that fails and a gold run that is lost after their claims; the next runs do their work, and runs
    after these find nothing pending."""
    lake = Lake(spark, scratch_path(spark, "lake"))
    ingest_bronze(lake, mix_documents(spark, sf_dir).select("raw_json"), flow_documents(spark, sf_dir).select("raw_json"), 1)
    ledger = lake.ledger
    ledger.open("silver", 2)
    ledger.claim("bronze", ledger.pending("bronze", "silver"), claimed_by=2)
    ledger.mark_error("silver", 2, "failed on purpose")
    ledger.release("bronze", [1])
    transform_silver(lake, 3)
    ledger.open("gold", 4)
    ledger.claim("silver", ledger.pending("silver", "gold"), claimed_by=4)  # and nothing more is heard of it
    transform_gold(lake, 5)
    for again in (transform_silver, transform_gold):
        if again(lake, 9)["status"] != "no_pending":
            raise AssertionError("a consumed batch was taken again")
    return ledger.state().select("process", "process_ts", "status", "record_count")


_ROUND = ["R", "P", "R", "P", "C", "R", "P"]  # what becomes of every batch: claimed, handed back, consumed, reopened


@query(f"""WITH days AS (SELECT event_id // 100 AS process_ts, min(ts::DATE) AS day FROM events GROUP BY 1),
placed AS (SELECT process_ts, dense_rank() OVER (ORDER BY day) - 1 AS i FROM days)
SELECT process_ts, {len(_ROUND)}::BIGINT AS n_changes, '{','.join(_ROUND)}' AS statuses,
  (i * {len(_ROUND)} + 1)::BIGINT AS first_commit, (i * {len(_ROUND)} + {len(_ROUND)})::BIGINT AS last_commit FROM placed""")
def ledger_history(spark, sf_dir):
    """Every change of every batch, day by day in one commit each, over several checkpoints of the ledger."""
    ledger = Lake(spark, scratch_path(spark, "history")).ledger
    batches = fx.events(spark, sf_dir).groupBy(fx.batch_of(F.col("event_id")).alias("process_ts")).agg(
        F.min(F.to_date("ts")).alias("day"))
    for row in batches.groupBy("day").agg(F.collect_list("process_ts").alias("ids")).orderBy("day").collect():
        for status in _ROUND:
            {"R": ledger.release, "P": ledger.claim, "C": ledger.mark_complete}[status]("bronze", row.ids)
        if ledger.uncollected() >= CHECKPOINT_EVERY:
            ledger.checkpoint()
    rows = ledger.history().select("process_ts", "status", "seq")
    return rows.groupBy("process_ts").agg(
        F.count(F.lit(1)).alias("n_changes"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "status"))), lambda c: c["status"]), ",").alias("statuses"),
        commit_of(F.min("seq")).alias("first_commit"), commit_of(F.max("seq")).alias("last_commit"))


# ---------------------------------------------------------------- SQL over written tables

def _gold_surface(spark, sf_dir) -> SqlSurface:
    """The three daily products written to a lake and registered under their names."""
    lake = Lake(spark, scratch_path(spark, "gold"))
    net = products.daily_net_flows(fx.silver_flows(spark, sf_dir), 1)
    frames = {
        "daily_electricity_mix": products.daily_mix(fx.silver_mix(spark, sf_dir), 1),
        "daily_imports": products.net_imports(net), "daily_exports": products.net_exports(net),
    }
    for name, df in frames.items():
        tables.append(df, lake.path("gold", name), DAY_COLUMNS)
    surface = SqlSurface(lake, f"q{uuid.uuid4().hex}_")
    surface.register()
    return surface


@query(f"""WITH {fx.READINGS_SQL}, {fx.wide_sql('readings')}, {fx.daily_mix_sql('wide')},
picked AS (SELECT zone, date, total_production_mwh FROM gold ORDER BY date DESC, zone LIMIT 10)
SELECT zone, {fx.date_sql('date')} AS date, round(total_production_mwh, 6) AS total_production_mwh FROM picked""")
def sql_latest_rows(spark, sf_dir):
    """Latest rows of a lake table by name, in an order without ties."""
    surface = _gold_surface(spark, sf_dir)
    return surface.sql(f"""SELECT zone, date, total_production_mwh FROM {surface.prefix}gold.daily_electricity_mix
        ORDER BY process_ts DESC, date DESC, zone LIMIT 10""")


@query(f"""WITH {fx.FLOWS_SQL}, {fx.net_flows_sql('flows')}
SELECT zone, sum(CASE WHEN net_flow > 0 THEN 1 ELSE 0 END)::BIGINT AS n_imports,
  sum(CASE WHEN net_flow < 0 THEN 1 ELSE 0 END)::BIGINT AS n_exports FROM net GROUP BY 1""")
def sql_bounded(spark, sf_dir):
    """A read-only query over the gold tables whose result is bounded."""
    surface = _gold_surface(spark, sf_dir)
    return surface.bounded(f"""
        WITH i AS (SELECT zone, count(*) AS n_imports FROM {surface.prefix}gold.daily_imports GROUP BY zone),
             e AS (SELECT zone, count(*) AS n_exports FROM daily_exports GROUP BY zone)
        SELECT zone, coalesce(n_imports, 0L) AS n_imports, coalesce(n_exports, 0L) AS n_exports
        FROM i FULL JOIN e USING (zone)""", rows=100)


@query(f"""WITH {_SILVER_MIX}, tables AS (
  SELECT 'silver_mix' AS name, least(count(*), 6) AS n_rows, '2' AS newest FROM good)
SELECT * FROM tables
UNION ALL SELECT name, 10, newest FROM (VALUES ('bronze_flows', '1'), ('bronze_mix', '1'), ('silver_flows', '2'),
  ('gold_exports', '3'), ('gold_imports', '3'), ('gold_mix', '3')) v(name, newest)
UNION ALL SELECT 'state', 3, '3'""")
def sql_inspections(spark, sf_dir):
    """The eight inspection queries: how many rows each shows and from which batch the first one is."""
    from wattlake.plans.sql_surface import INSPECTIONS

    surface = SqlSurface(run_jobs(spark, sf_dir), f"q{uuid.uuid4().hex}_")
    surface.register()
    shown = [
        surface.latest_rows(table, rows).agg(
            F.lit(name).alias("name"), F.count(F.lit(1)).alias("n_rows"),
            F.max("process_ts").cast("string").alias("newest"))
        for name, (table, rows) in INSPECTIONS.items()
    ]
    return tables.union_all(shown)
