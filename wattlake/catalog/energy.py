"""Daily products, keys, contracts, ledger and SQL questions over ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.catalog import fixtures as fx
from wattlake.catalog.registry import query
from wattlake.functions.energy import with_zone_names, zone_name
from wattlake.operators import contracts, keys, ledger, products
from wattlake.operators.keys import latest_by_key
from wattlake.schemas import FLOW_KEYS, LEDGER_STATE, MIX_KEYS, SOURCES
from wattlake.sources import tables

_MIX = f"WITH {fx.READINGS_SQL}, {fx.wide_sql('readings')}, {fx.daily_mix_sql('wide')}\n"
_NET = f"WITH {fx.FLOWS_SQL}, {fx.net_flows_sql('flows')}\n"
_IMPORTS = fx.exchange_columns_sql("source_zone", "import_mwh", "net_flow")
_EXPORTS = fx.exchange_columns_sql("destination_zone", "export_mwh", "-net_flow")


def gold_mix(spark, sf_dir):
    return products.daily_mix(fx.silver_mix(spark, sf_dir), 0)


def net_flows(spark, sf_dir):
    return products.daily_net_flows(fx.silver_flows(spark, sf_dir), 0)


# ---------------------------------------------------------------- products

@query(_MIX + f"SELECT {fx.gold_mix_columns_sql()} FROM gold")
def daily_relative_mix(spark, sf_dir):
    """Percent of each source in a zone's daily production."""
    return gold_mix(spark, sf_dir)


@query(_NET + f"""SELECT zone, neighbor_zone, {fx.date_sql('date')} AS date,
  round(gross_import_mwh, 6) AS gross_import_mwh, round(gross_export_mwh, 6) AS gross_export_mwh,
  round(net_flow, 6) AS net_flow, hours_covered FROM net""")
def daily_net_flows(spark, sf_dir):
    return net_flows(spark, sf_dir).select(
        "zone", "neighbor_zone", "date", "gross_import_mwh", "gross_export_mwh", "net_flow", "hours_covered")


@query(_NET + f"SELECT {_IMPORTS} FROM net WHERE net_flow > 0")
def daily_net_imports(spark, sf_dir):
    return products.net_imports(net_flows(spark, sf_dir))


@query(_NET + f"SELECT {_EXPORTS} FROM net WHERE net_flow < 0")
def daily_net_exports(spark, sf_dir):
    return products.net_exports(net_flows(spark, sf_dir))


@query(f"""WITH {fx.READINGS_SQL}
SELECT zone, {fx.date_sql('datetime')} AS date, count(DISTINCT datetime)::INTEGER AS hours_covered
FROM readings GROUP BY 1, 2""")
def hours_covered(spark, sf_dir):
    return products.daily_energy(fx.silver_mix(spark, sf_dir)).select("zone", "date", "hours_covered")


@query(_MIX + f"""SELECT zone, {fx.date_sql('min(date)')} AS first_date, {fx.date_sql('max(date)')} AS last_date,
  count(*) AS n_days, sum(CASE WHEN hours_covered < 24 THEN 1 ELSE 0 END)::BIGINT AS incomplete_days,
  (max(date) - min(date) + 1 - count(*))::BIGINT AS missing_days,
  (DATE '2024-02-15' - max(date))::BIGINT AS stale_days
FROM gold GROUP BY zone""")
def coverage_report(spark, sf_dir):
    return products.coverage(gold_mix(spark, sf_dir), F.lit("2024-02-15").cast("date"))


@query(f"""WITH {fx.READINGS_SQL},
expected AS (SELECT zone, unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:00:00',
             INTERVAL 1 HOUR)) AS datetime FROM (SELECT DISTINCT zone FROM readings))
SELECT zone, {fx.time_sql('datetime')} AS datetime
FROM expected e WHERE NOT EXISTS (
  SELECT 1 FROM readings r WHERE r.zone = e.zone AND r.datetime = e.datetime)""")
def missing_hours(spark, sf_dir):
    return products.missing_hours(
        fx.readings(spark, sf_dir),
        F.lit("2024-01-01 00:00:00").cast("timestamp"), F.lit("2024-01-30 23:00:00").cast("timestamp"))


@query(f"""WITH {fx.READINGS_SQL}, zones AS (SELECT DISTINCT zone FROM readings UNION ALL SELECT 'nation ' || n_nationkey FROM nation),
missing AS (SELECT zone, hour FROM zones, (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:00:00',
    INTERVAL 1 HOUR)) AS hour) WHERE NOT EXISTS (SELECT 1 FROM readings r WHERE r.zone = zones.zone AND r.datetime = hour)),
islands AS (SELECT zone, hour, hour - INTERVAL 1 HOUR * row_number() OVER (PARTITION BY zone ORDER BY hour) AS island FROM missing)
SELECT zone, {fx.time_sql('min(hour)')} AS gap_start, {fx.time_sql('max(hour)')} AS gap_end, count(*) AS n_hours
FROM islands GROUP BY zone, island""")
def missing_intervals(spark, sf_dir):
    """Stretches of hours without a reading, over zones that have readings and others that never had one."""
    readings = fx.readings(spark, sf_dir)
    others = fx.table(spark, sf_dir, "nation").select(F.concat(F.lit("nation "), F.col("n_nationkey")).alias("zone"))
    return products.missing_intervals(
        readings, readings.select("zone").distinct().unionByName(others),
        F.lit("2024-01-01 00:00:00").cast("timestamp"), F.lit("2024-01-30 23:00:00").cast("timestamp"))


@query(f"""WITH {fx.READINGS_SQL}
SELECT zone, {fx.ZONE_NAME_SQL.format('zone')} AS zone_name, count(*) AS n_rows FROM readings GROUP BY 1, 2""")
def zone_name_lookup(spark, sf_dir):
    """Zone names through a literal lookup, unknown codes standing for themselves."""
    return (
        fx.readings(spark, sf_dir).groupBy("zone").agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("zone_name", zone_name(F.col("zone")))
    )


@query("""SELECT event_type, 'nation ' || (user_id % 40) AS code,
  coalesce(n_name, 'nation ' || (user_id % 40)) AS name, count(*) AS n_rows
FROM events LEFT JOIN nation ON n_nationkey = user_id % 40 GROUP BY 1, 2, 3""")
def dimension_lookup(spark, sf_dir):
    """The same lookup against a dimension table that lacks some codes."""
    nations = fx.table(spark, sf_dir, "nation").select(
        F.concat(F.lit("nation "), F.col("n_nationkey")).alias("code"), F.col("n_name").alias("name"))
    counted = (
        fx.events(spark, sf_dir)
        .withColumn("code", F.concat(F.lit("nation "), F.pmod("user_id", F.lit(40))))
        .groupBy("event_type", "code").agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return with_zone_names(counted, nations, "code", "name")


@query(f"""WITH {fx.READINGS_SQL}
SELECT process_ts, count(*) AS n_rows, round(sum(mw), 6) AS total_mw,
  {fx.time_sql('min(datetime)')} AS first_hour, {fx.time_sql('max(datetime)')} AS last_hour
FROM readings GROUP BY 1""")
def batch_metrics(spark, sf_dir):
    return fx.readings(spark, sf_dir).groupBy("process_ts").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("mw").alias("total_mw"),
        F.min("datetime").alias("first_hour"), F.max("datetime").alias("last_hour"))


# ---------------------------------------------------------------- keys

@query(f"""WITH {fx.READINGS_SQL}
SELECT event_id, zone, {fx.time_sql('datetime')} AS datetime, {fx.time_sql('updated_at')} AS updated_at, source, mw
FROM readings QUALIFY row_number() OVER (PARTITION BY zone, datetime ORDER BY updated_at DESC, event_id DESC) = 1""")
def dedup_latest_mix(spark, sf_dir):
    rows = fx.readings(spark, sf_dir).drop("process_ts")
    return latest_by_key(rows, MIX_KEYS, ["updated_at", "event_id"])


_LATEST_FLOWS = """latest AS (SELECT * EXCLUDE (datetime) RENAME (daytime AS datetime) FROM flows
QUALIFY row_number() OVER (PARTITION BY zone, daytime, neighbor_zone, direction
                           ORDER BY updated_at DESC, event_id DESC) = 1)"""


@query(f"""WITH {fx.FLOWS_SQL}, {_LATEST_FLOWS}
SELECT event_id, zone, {fx.time_sql('datetime')} AS datetime, neighbor_zone, direction, power_mw FROM latest""")
def dedup_latest_flows(spark, sf_dir):
    rows = fx.silver_flows(spark, sf_dir, hourly=False)
    return latest_by_key(rows, FLOW_KEYS, ["updated_at", "event_id"]).select("event_id", *FLOW_KEYS, "power_mw")


@query(f"""WITH {fx.READINGS_SQL}
SELECT zone, {fx.time_sql('datetime')} AS datetime, count(*) AS n_rows
FROM readings GROUP BY zone, readings.datetime HAVING count(*) > 1""")
def duplicate_keys(spark, sf_dir):
    return keys.duplicate_keys(fx.readings(spark, sf_dir), MIX_KEYS)


# ---------------------------------------------------------------- scans by batch and day

def batch_log(spark, sf_dir):
    """A status log of the reading batches: the type of an event is a status change of its batch."""
    status = F.when(F.col("event_type") == "view", "R").otherwise("C")
    return ledger.log_rows(fx.events(spark, sf_dir), process=F.lit("bronze"), process_ts=fx.batch_of(F.col("event_id")),
                           seq=F.col("event_id"), status=status)


def pending_batches(spark, sf_dir):
    return ledger.ready_batches(batch_log(spark, sf_dir), "bronze")


_PENDING = """pending AS (SELECT event_id // 100 AS process_ts FROM events
  GROUP BY 1 HAVING arg_max(event_type, event_id) = 'view')"""


@query(f"""WITH {fx.READINGS_SQL}, {_PENDING}
SELECT process_ts, count(*) AS n_rows, round(sum(mw), 6) AS total_mw
FROM readings WHERE process_ts IN (SELECT process_ts FROM pending) GROUP BY 1""")
def pending_batch_scan(spark, sf_dir):
    """Rows of the batches that the ledger lists as ready."""
    rows = tables.only_batches(fx.readings(spark, sf_dir), pending_batches(spark, sf_dir))
    return rows.groupBy("process_ts").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("mw").alias("total_mw"))


@query(f"""WITH {fx.READINGS_SQL}, {fx.FLOWS_SQL}, {_PENDING}
SELECT DISTINCT year(datetime)::INTEGER AS year, month(datetime)::INTEGER AS month, day(datetime)::INTEGER AS day
FROM (SELECT datetime, process_ts FROM readings UNION ALL SELECT datetime, process_ts FROM flows)
WHERE process_ts IN (SELECT process_ts FROM pending)""")
def affected_days(spark, sf_dir):
    """Days on which ready batches brought rows."""
    pending = pending_batches(spark, sf_dir)
    return tables.affected_days_frame(
        tables.only_batches(fx.silver_mix(spark, sf_dir), pending),
        tables.only_batches(fx.silver_flows(spark, sf_dir), pending))


@query(f"""WITH {fx.READINGS_SQL}, {fx.FLOWS_SQL}
SELECT kind, zone, count(*) AS n_rows, round(sum(mw), 6) AS total_mw, max(neighbor_zone) AS last_neighbor FROM (
  SELECT 'mix' AS kind, zone, mw, NULL AS neighbor_zone FROM readings
  UNION ALL SELECT 'flows', zone, power_mw, neighbor_zone FROM flows) GROUP BY 1, 2""")
def union_relaxed(spark, sf_dir):
    """UNION ALL of frames with different columns: those missing become null."""
    mix = fx.readings(spark, sf_dir).select(F.lit("mix").alias("kind"), "zone", "mw")
    flows = fx.silver_flows(spark, sf_dir).select(
        F.lit("flows").alias("kind"), "zone", F.col("power_mw").alias("mw"), "neighbor_zone")
    return tables.union_all([mix, flows]).groupBy("kind", "zone").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("mw").alias("total_mw"),
        F.max("neighbor_zone").alias("last_neighbor"))


@query(f"""WITH {fx.FLOWS_SQL}
SELECT direction, neighbor_zone, count(*) AS n_rows, max(event_id) AS last_event FROM flows GROUP BY 1, 2""")
def union_batches(spark, sf_dir):
    """Batches of one schema put together again."""
    flows = fx.silver_flows(spark, sf_dir)
    batches = [flows.where(F.col("direction") == d) for d in ("import", "export")]
    return tables.union_all(batches).groupBy("direction", "neighbor_zone").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("event_id").alias("last_event"))


# ---------------------------------------------------------------- contracts

_BROKEN_FLOW = """SELECT event_id, zone, CASE WHEN event_type = 'error' THEN 'sideways' WHEN event_type IN ('click', 'view')
    THEN 'import' ELSE 'export' END AS direction, CASE WHEN user_id < 10 THEN NULL ELSE value END AS power_mw
  FROM (SELECT *, {zones}[1 + user_id % 8] AS zone FROM events)""".format(zones=fx._ZONE_LIST)


def flows_with_defects(spark, sf_dir):
    """Flows in which error events have no valid direction and the first users no power."""
    return fx.silver_flows(spark, sf_dir, extra=["event_type", "user_id"]).withColumns({
        "direction": F.when(F.col("event_type") == "error", "sideways").otherwise(F.col("direction")),
        "power_mw": F.when(F.col("user_id") >= 10, F.col("power_mw")),
    })


_VIOLATIONS = f"""broken AS ({_BROKEN_FLOW}),
checked AS (SELECT *, concat_ws(',', CASE WHEN power_mw IS NULL THEN 'not_null:power_mw' END,
  CASE WHEN direction NOT IN ('import', 'export') THEN 'allowed:direction' END) AS v FROM broken)"""


@query(f"""WITH {_VIOLATIONS}
SELECT zone, direction, v AS violations, count(*) AS n_rows FROM checked GROUP BY 1, 2, 3""")
def contract_split(spark, sf_dir):
    """Good and bad rows of the flow contract, with the rules broken."""
    checked = contracts.SILVER_FLOWS.check(flows_with_defects(spark, sf_dir))
    return checked.groupBy("zone", "direction", F.array_join("violations", ",").alias("violations")).agg(
        F.count(F.lit(1)).alias("n_rows"))


@query(f"""WITH {_VIOLATIONS}
SELECT rule, count(*) AS n_rows FROM (SELECT unnest(string_split(v, ',')) AS rule FROM checked WHERE v <> '') GROUP BY 1""")
def contract_violation_counts(spark, sf_dir):
    return contracts.violation_counts(contracts.SILVER_FLOWS.check(flows_with_defects(spark, sf_dir)))


_TIGHT = {f"{s}_pct": (0.0, 20.0) for s in SOURCES}


@query(_MIX + """, hits AS (SELECT unnest([""" + ", ".join(
    f"CASE WHEN {s}_pct > 20 + 1e-9 THEN 'range:{s}_pct' END" for s in SOURCES
) + """, CASE WHEN hours_covered > 12 THEN 'range:hours_covered' END]) AS rule FROM gold)
SELECT rule, count(*) AS n_rows FROM hits WHERE rule IS NOT NULL GROUP BY 1""")
def contract_ranges(spark, sf_dir):
    """Range rules over the daily mix, with bounds tight enough to be broken."""
    tight = contracts.Contract(
        contracts.GOLD_MIX.schema, contracts.GOLD_MIX.required, {**_TIGHT, "hours_covered": (1, 12)})
    return contracts.violation_counts(tight.check(gold_mix(spark, sf_dir)))


# ---------------------------------------------------------------- ledger

def ledger_log(spark, sf_dir):
    """A status log made of all events: the n-th event of a user within an hour is a change of that batch."""
    rows = fx.events(spark, sf_dir)
    status = (
        F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "view", "R")
        .when(F.col("event_type") == "click", "P").when(F.col("event_type") == "purchase", "C")
        .otherwise("I")
    )
    failed, view = F.col("event_type") == "error", F.col("event_type") == "view"
    layers = F.array(F.lit("bronze"), F.lit("silver"), F.lit("gold"))
    return ledger.log_rows(
        rows,
        process=F.element_at(layers, (F.pmod("user_id", F.lit(3)) + 1).cast("int")),
        process_ts=F.unix_millis(F.date_trunc("hour", "ts")),
        seq=F.col("event_id"),
        status=status,
        start_timestamp=F.when(F.col("event_type") == "signup", F.col("ts")),
        end_timestamp=F.when(view, F.col("ts")),
        record_count=F.when(view, F.col("event_id")),
        error_message=F.when(failed, F.concat(F.lit("failed at "), F.col("event_id"))),
        range_end=F.when(view, F.date_trunc("hour", "ts") + F.expr("INTERVAL 1 HOUR")),
    )


_LOG = """log AS (SELECT ['bronze', 'silver', 'gold'][1 + user_id % 3] AS process,
  epoch_ms(date_trunc('hour', ts)) AS process_ts, event_id AS seq,
  CASE event_type WHEN 'view' THEN 'R' WHEN 'click' THEN 'P' WHEN 'purchase' THEN 'C' ELSE 'I' END AS status,
  CASE WHEN event_type = 'signup' THEN ts END AS start_timestamp,
  CASE WHEN event_type = 'view' THEN ts END AS end_timestamp,
  CASE WHEN event_type = 'view' THEN event_id END AS record_count,
  CASE WHEN event_type = 'error' THEN 'failed at ' || event_id END AS error_message,
  CASE WHEN event_type = 'view' THEN date_trunc('hour', ts) + INTERVAL 1 HOUR END AS range_end FROM events),
last_value AS (SELECT process, process_ts, max(seq) AS s, max(seq) FILTER (WHERE start_timestamp IS NOT NULL) AS s1,
  max(seq) FILTER (WHERE end_timestamp IS NOT NULL) AS s2, max(seq) FILTER (WHERE record_count IS NOT NULL) AS s3,
  max(seq) FILTER (WHERE error_message IS NOT NULL) AS s4 FROM log GROUP BY 1, 2),
state AS (SELECT v.process, v.process_ts, a.status, b.start_timestamp, c.end_timestamp, d.record_count,
  e.error_message, c.range_end FROM last_value v JOIN log a ON a.seq = v.s LEFT JOIN log b ON b.seq = v.s1
  LEFT JOIN log c ON c.seq = v.s2 LEFT JOIN log d ON d.seq = v.s3 LEFT JOIN log e ON e.seq = v.s4)"""


@query(f"""WITH {_LOG} SELECT process, process_ts, {fx.time_sql('start_timestamp')} AS start_timestamp,
  {fx.time_sql('end_timestamp')} AS end_timestamp, status, record_count, error_message FROM state""")
def ledger_current_state(spark, sf_dir):
    return ledger.current_state(ledger_log(spark, sf_dir)).select(*LEDGER_STATE.fieldNames())


@query(f"WITH {_LOG} SELECT process_ts FROM state WHERE process = 'silver' AND status = 'R'")
def ledger_ready(spark, sf_dir):
    return ledger.ready_batches(ledger_log(spark, sf_dir), "silver")


@query(f"""WITH {_LOG} SELECT max(process_ts) AS process_ts,
  {fx.time_sql('make_timestamp(max(process_ts) * 1000)')} AS batch_time FROM log WHERE process = 'gold'""")
def ledger_last_batch(spark, sf_dir):
    return ledger.last_batch(ledger_log(spark, sf_dir), "gold")


@query(f"""WITH {_LOG}, done AS (SELECT max(coalesce(range_end, make_timestamp(process_ts * 1000))) AS e FROM state
  WHERE process = 'bronze' AND status IN ('R', 'P', 'C'))
SELECT {fx.time_sql("least(date_trunc('hour', e), TIMESTAMP '2024-02-01 04:00:00')")} AS range_start,
  '2024-02-01 05:00:00.000000' AS range_end FROM done""")
def catch_up_window(spark, sf_dir):
    now = F.lit("2024-02-01 05:30:00").cast("timestamp")
    return ledger.catch_up_window(ledger_log(spark, sf_dir), "bronze", now)


# ---------------------------------------------------------------- questions in SQL

def _views(spark, sf_dir):
    """The three daily products as views, under names no other session code uses."""
    net = net_flows(spark, sf_dir)
    frames = {"mix": gold_mix(spark, sf_dir), "imports": products.net_imports(net), "exports": products.net_exports(net)}
    for name, df in frames.items():
        df.createOrReplaceTempView(f"wattlake_daily_{name}")


def _ask(spark, sf_dir, text, args=None):
    _views(spark, sf_dir)
    return spark.sql(text, args or {})


@query(_MIX + """SELECT zone_name, round(avg(renewable_avg_pct), 6) AS renewable FROM (
  SELECT *, """ + fx.ZONE_NAME_SQL.format("zone") + """ AS zone_name FROM gold) WHERE zone_name = 'France' GROUP BY 1""")
def sql_avg_renewable(spark, sf_dir):
    """Mean daily renewable share of one zone, asked by its name."""
    return _ask(spark, sf_dir, """SELECT zone_name, avg(renewable_avg_pct) AS renewable FROM wattlake_daily_mix
        WHERE zone_name = :zone GROUP BY zone_name""", {"zone": "France"})


@query(_NET + """SELECT neighbor_zone AS destination_zone_name, round(sum(-net_flow), 6) AS exported_mwh
FROM net WHERE net_flow < 0 AND zone = 'FR' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""")
def sql_top3_destinations(spark, sf_dir):
    """The three neighbours that take most from one zone."""
    return _ask(spark, sf_dir, """SELECT destination_zone_name, sum(export_mwh) AS exported_mwh
        FROM wattlake_daily_exports WHERE zone = :zone GROUP BY ALL
        ORDER BY round(exported_mwh, 6) DESC, destination_zone_name LIMIT 3""", {"zone": "FR"})


@query(_MIX + f"""SELECT zone, {fx.date_sql('date')} AS date, round(renewable_avg_pct, 6) AS renewable_avg_pct
FROM gold WHERE zone = 'FR' AND date = DATE '2024-01-15'""")
def sql_share_on_date(spark, sf_dir):
    return _ask(spark, sf_dir, """SELECT zone, date, renewable_avg_pct FROM wattlake_daily_mix
        WHERE zone = :zone AND date = CAST(:day AS DATE)""", {"zone": "FR", "day": "2024-01-15"})


@query(_MIX + f"""SELECT {fx.date_sql('date')} AS date, round(avg(fossil_free_avg_pct), 6) AS fossil_free,
  round(sum(total_production_mwh), 6) AS production_mwh, count(*) AS n_zones FROM gold GROUP BY gold.date""")
def sql_daily_trend(spark, sf_dir):
    return _ask(spark, sf_dir, """SELECT date, avg(fossil_free_avg_pct) AS fossil_free,
        sum(total_production_mwh) AS production_mwh, count(*) AS n_zones FROM wattlake_daily_mix GROUP BY date""")


@query(f"""WITH {fx.READINGS_SQL}, {fx.wide_sql('readings')}, {fx.daily_mix_sql('wide')},
{fx.FLOWS_SQL}, {fx.net_flows_sql('flows')}
SELECT g.zone, {fx.date_sql('g.date')} AS date, round(any_value(total_production_mwh), 6) AS total_production_mwh,
  round(coalesce(sum(net_flow), 0), 6) AS imported_mwh, count(neighbor_zone) AS n_sources
FROM gold g LEFT JOIN (SELECT * FROM net WHERE net_flow > 0) n ON n.zone = g.zone AND n.date = g.date
GROUP BY g.zone, g.date""")
def sql_mix_join_imports(spark, sf_dir):
    return _ask(spark, sf_dir, """SELECT m.zone, m.date, m.total_production_mwh,
          coalesce(i.imported_mwh, 0D) AS imported_mwh, coalesce(i.n_sources, 0L) AS n_sources
        FROM wattlake_daily_mix m LEFT JOIN (
          SELECT zone, date, sum(import_mwh) AS imported_mwh, count(*) AS n_sources
          FROM wattlake_daily_imports GROUP BY zone, date) i ON i.zone = m.zone AND i.date = m.date""")
