"""Table schemas. Column names and order are fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

DAY_COLUMNS = ["year", "month", "day"]

# Production sources of one mix reading (fixed values).
SOURCES = [
    "nuclear", "geothermal", "biomass", "coal", "wind",
    "solar", "hydro", "gas", "oil", "unknown",
]
RENEWABLE = ["geothermal", "biomass", "wind", "solar", "hydro"]
FOSSIL_FREE = ["nuclear", *RENEWABLE]

# Order in which the daily product publishes its percentages (fixed values).
PUBLISHED_SOURCES = [
    "nuclear", "biomass", "wind", "solar", "hydro",
    "gas", "oil", "coal", "geothermal", "unknown",
]

STORAGE_FIELDS = {
    "hydro storage": ("charge", "discharge"),
    "battery storage": ("charge", "discharge"),
}

_DAY_DDL = "year INT, month INT, day INT"


def _doubles(names: list[str]) -> str:
    return ", ".join(f"{name} DOUBLE" for name in names)


_TYPES = {
    "BIGINT": T.LongType(), "INT": T.IntegerType(), "STRING": T.StringType(), "DOUBLE": T.DoubleType(),
    "INTS": T.ArrayType(T.IntegerType()), "BOOLEAN": T.BooleanType(), "TIMESTAMP": T.TimestampType(), "DATE": T.DateType(),
}


def _schema(columns: str) -> T.StructType:
    """``'a BIGINT, b STRING'`` to a schema, without needing a running session."""
    fields = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


BRONZE = _schema(
    "process_ts BIGINT, ingestion_timestamp TIMESTAMP, source_url STRING, zone STRING, "
    "range_start TIMESTAMP, range_end TIMESTAMP, raw_json STRING, record_count BIGINT, " + _DAY_DDL
)

MIX_VALUE_COLUMNS = (
    [f"{s}_mw" for s in SOURCES]
    + [f"{group.replace(' ', '_')}_{side}_mw" for group, sides in STORAGE_FIELDS.items() for side in sides]
    + ["flow_exports_mw", "flow_imports_mw"]
)

SILVER_MIX = _schema(
    "process_ts BIGINT, zone STRING, datetime TIMESTAMP, updated_at TIMESTAMP, "
    f"is_estimated BOOLEAN, estimation_method STRING, {_doubles(MIX_VALUE_COLUMNS)}, {_DAY_DDL}"
)

SILVER_FLOWS = _schema(
    "process_ts BIGINT, zone STRING, datetime TIMESTAMP, updated_at TIMESTAMP, "
    f"neighbor_zone STRING, direction STRING, power_mw DOUBLE, {_DAY_DDL}"
)

BAD_DATA = _schema(
    "process_ts BIGINT, datetime STRING, raw_json STRING, error_message STRING, created_at TIMESTAMP"
)

GOLD_MIX = _schema(
    "process_ts BIGINT, zone STRING, zone_name STRING, date DATE, "
    f"{_doubles([f'{s}_pct' for s in PUBLISHED_SOURCES])}, total_production_mwh DOUBLE, "
    f"fossil_free_avg_pct DOUBLE, renewable_avg_pct DOUBLE, hours_covered INT, {_DAY_DDL}"
)


def _gold_exchange(other: str, energy: str) -> T.StructType:
    return _schema(
        f"process_ts BIGINT, zone STRING, zone_name STRING, {other} STRING, {other}_name STRING, "
        f"date DATE, {energy} DOUBLE, hours_covered INT, {_DAY_DDL}"
    )


GOLD_IMPORTS = _gold_exchange("source_zone", "import_mwh")
GOLD_EXPORTS = _gold_exchange("destination_zone", "export_mwh")

LEDGER_LOG = _schema(
    "process STRING, process_ts BIGINT, seq BIGINT, status STRING, start_timestamp TIMESTAMP, "
    "end_timestamp TIMESTAMP, record_count BIGINT, error_message STRING, range_end TIMESTAMP, days INTS, claimed_by BIGINT"
)
LEDGER_STATE = _schema(
    "process STRING, process_ts BIGINT, start_timestamp TIMESTAMP, end_timestamp TIMESTAMP, "
    "status STRING, record_count BIGINT, error_message STRING"
)

# Business keys.
MIX_KEYS = ["zone", "datetime"]
FLOW_KEYS = ["zone", "datetime", "neighbor_zone", "direction"]
GOLD_MIX_KEYS = ["zone", "date"]
GOLD_IMPORT_KEYS = ["zone", "source_zone", "date"]
GOLD_EXPORT_KEYS = ["zone", "destination_zone", "date"]
