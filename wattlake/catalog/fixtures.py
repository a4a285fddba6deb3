"""The given tables in the shapes of the data model, in Spark and in SQL.

Every event is one hourly reading of one zone and source, and one exchange with one neighbour. All
rows of ``events`` are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.functions.timecols import day_columns
from wattlake.schemas import SOURCES
from wattlake.sources.tables import spread

# Eight zones, the last one without a name.
ZONES = ["FR", "DE", "ES", "IT-NO", "CH", "BE", "GB", "XX"]
# Two sources per event type, for even and odd groups of users.
SOURCE_OF_EVENT = {
    "click": ("nuclear", "geothermal"), "error": ("coal", "oil"), "purchase": ("wind", "solar"),
    "signup": ("hydro", "biomass"), "view": ("gas", "unknown"),
}
IMPORT_EVENTS = ["click", "view", "error"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def zone_of(user: Column) -> Column:
    return F.element_at(F.array(*[F.lit(z) for z in ZONES]), (F.pmod(user, F.lit(8)) + 1).cast("int"))


def source_of(event_type: Column, user: Column) -> Column:
    odd = F.pmod(whole_part(user, 8), F.lit(2)) == 1
    chain = None
    for kind, (even_source, odd_source) in SOURCE_OF_EVENT.items():
        value = F.when(odd, odd_source).otherwise(even_source)
        chain = F.when(event_type == kind, value) if chain is None else chain.when(event_type == kind, value)
    return chain


def whole_part(value: Column, divisor: int) -> Column:
    return F.call_function("div", value, F.lit(divisor))


def batch_of(event_id: Column) -> Column:
    """A batch holds a hundred consecutive events."""
    return whole_part(event_id, 100)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, process_ts, zone, datetime, updated_at, source, mw``"""
    return events(spark, sf_dir).select(
        "event_id",
        batch_of(F.col("event_id")).alias("process_ts"),
        zone_of(F.col("user_id")).alias("zone"),
        F.date_trunc("hour", "ts").alias("datetime"),
        F.col("ts").alias("updated_at"),
        source_of(F.col("event_type"), F.col("user_id")).alias("source"),
        F.col("value").alias("mw"),
    )


def silver_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with a column per source, and day columns."""
    rows = readings(spark, sf_dir)
    return rows.select(
        "event_id", "process_ts", "zone", "datetime", "updated_at",
        *[F.when(F.col("source") == s, F.col("mw")).alias(f"{s}_mw") for s in SOURCES],
        *[c.alias(n) for n, c in day_columns(F.col("datetime")).items()],
    )


def silver_flows(spark: SparkSession, sf_dir: str, hourly: bool = True, extra: Sequence[str] = ()) -> DataFrame:
    """``event_id, process_ts, zone, datetime, updated_at, neighbor_zone, direction, power_mw`` and days.

    With ``hourly=False`` the timestamps are cut to the day, so that keys repeat. ``extra`` names columns
    of ``events`` to keep.
    """
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("nation"), F.col("n_name").alias("neighbor_zone"))
    rows = events(spark, sf_dir).withColumn("nation", F.pmod("event_id", F.lit(25)))
    when = F.date_trunc("hour" if hourly else "day", "ts")
    return rows.join(nations, "nation").select(
        "event_id",
        batch_of(F.col("event_id")).alias("process_ts"),
        zone_of(F.col("user_id")).alias("zone"),
        when.alias("datetime"),
        F.col("ts").alias("updated_at"),
        "neighbor_zone",
        F.when(F.col("event_type").isin(IMPORT_EVENTS), "import").otherwise("export").alias("direction"),
        F.col("value").alias("power_mw"),
        *[c.alias(n) for n, c in day_columns(when).items()],
        *extra,
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work on texts is heavy per row, so a small table is spread over all cores."""
    return spread(table(spark, sf_dir, "documents"))


# ---------------------------------------------------------------- the same in SQL

_ZONE_LIST = "[" + ", ".join(f"'{z}'" for z in ZONES) + "]"
_SOURCE_CASE = "CASE event_type " + " ".join(
    f"WHEN '{kind}' THEN CASE WHEN (user_id // 8) % 2 = 1 THEN '{odd}' ELSE '{even}' END"
    for kind, (even, odd) in SOURCE_OF_EVENT.items()
) + " END"

READINGS_SQL = f"""readings AS (
  SELECT event_id, event_id // 100 AS process_ts, {_ZONE_LIST}[1 + user_id % 8] AS zone,
         date_trunc('hour', ts) AS datetime, ts AS updated_at, {_SOURCE_CASE} AS source, value AS mw
  FROM events)"""

FLOWS_SQL = f"""flows AS (
  SELECT event_id, event_id // 100 AS process_ts, {_ZONE_LIST}[1 + user_id % 8] AS zone,
         date_trunc('hour', ts) AS datetime, date_trunc('day', ts) AS daytime, ts AS updated_at,
         n_name AS neighbor_zone,
         CASE WHEN event_type IN ('click', 'view', 'error') THEN 'import' ELSE 'export' END AS direction,
         value AS power_mw
  FROM events JOIN nation ON n_nationkey = event_id % 25)"""

ZONE_NAME_SQL = """CASE {0} WHEN 'FR' THEN 'France' WHEN 'DE' THEN 'Germany' WHEN 'ES' THEN 'Spain'
  WHEN 'IT-NO' THEN 'Italy North' WHEN 'CH' THEN 'Switzerland' WHEN 'BE' THEN 'Belgium'
  WHEN 'GB' THEN 'Great Britain' ELSE {0} END"""


def time_sql(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def date_sql(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def days_sql(column: str) -> str:
    return (f"year({column})::INTEGER AS year, month({column})::INTEGER AS month, "
            f"day({column})::INTEGER AS day")


def wide_sql(rows: str, name: str = "wide") -> str:
    """Rows with ``zone, datetime, source, mw`` as one column per source."""
    columns = ", ".join(f"CASE WHEN source = '{s}' THEN mw END AS {s}_mw" for s in SOURCES)
    return f"{name} AS (SELECT * EXCLUDE (source, mw), {columns} FROM {rows})"


def daily_mix_sql(wide: str, name: str = "gold") -> str:
    """The daily mix of wide rows: unrounded percentages and totals."""
    from wattlake.schemas import FOSSIL_FREE, PUBLISHED_SOURCES, RENEWABLE

    sums = ", ".join(f"coalesce(sum({s}_mw), 0) AS {s}" for s in SOURCES)
    total = " + ".join(SOURCES)
    share = {s: f"CASE WHEN total > 0 THEN {s} / total * 100 ELSE 0 END" for s in SOURCES}
    shares = ", ".join(f"{share[s]} AS {s}_pct" for s in PUBLISHED_SOURCES)
    portfolio = ", ".join(
        f"{' + '.join(f'{s}_pct' for s in group)} AS {column}"
        for group, column in ((FOSSIL_FREE, "fossil_free_avg_pct"), (RENEWABLE, "renewable_avg_pct"))
    )
    return f"""{name}_e AS (
  SELECT zone, datetime::DATE AS date, {sums}, count(DISTINCT datetime)::INTEGER AS hours_covered
  FROM {wide} GROUP BY 1, 2),
{name}_t AS (SELECT *, {total} AS total FROM {name}_e),
{name}_s AS (SELECT zone, date, {shares}, total::DOUBLE AS total_production_mwh, hours_covered FROM {name}_t),
{name} AS (SELECT *, {portfolio} FROM {name}_s)"""


def gold_mix_columns_sql(process_ts: str = "0") -> str:
    """The published columns of a daily mix, rounded and as text where needed."""
    from wattlake.schemas import PUBLISHED_SOURCES

    shares = ", ".join(f"round({s}_pct, 6) AS {s}_pct" for s in PUBLISHED_SOURCES)
    return (
        f"{process_ts}::BIGINT AS process_ts, zone, {ZONE_NAME_SQL.format('zone')} AS zone_name, "
        f"{date_sql('date')} AS date, {shares}, round(total_production_mwh, 6) AS total_production_mwh, "
        "round(fossil_free_avg_pct, 6) AS fossil_free_avg_pct, round(renewable_avg_pct, 6) AS renewable_avg_pct, "
        f"hours_covered, {days_sql('date')}"
    )


def net_flows_sql(flows: str, name: str = "net") -> str:
    return f"""{name} AS (
  SELECT zone, neighbor_zone, datetime::DATE AS date,
         coalesce(sum(power_mw) FILTER (WHERE direction = 'import'), 0) AS gross_import_mwh,
         coalesce(sum(power_mw) FILTER (WHERE direction = 'export'), 0) AS gross_export_mwh,
         gross_import_mwh - gross_export_mwh AS net_flow,
         count(DISTINCT datetime)::INTEGER AS hours_covered
  FROM {flows} GROUP BY 1, 2, 3)"""


def exchange_columns_sql(other: str, energy: str, value: str, process_ts: str = "0") -> str:
    return (
        f"{process_ts}::BIGINT AS process_ts, zone, {ZONE_NAME_SQL.format('zone')} AS zone_name, "
        f"neighbor_zone AS {other}, {ZONE_NAME_SQL.format('neighbor_zone')} AS {other}_name, "
        f"{date_sql('date')} AS date, round({value}, 6) AS {energy}, hours_covered, {days_sql('date')}"
    )
