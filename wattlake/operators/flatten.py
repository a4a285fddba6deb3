"""Raw JSON documents to typed rows, with quarantine per record.

Each document is parsed into the texts of its records (``array<string>`` keeps the original text),
exploded, and every record is parsed once into the fields wanted. A record either yields rows or
one error code, never both. Only where a field is missing is the record looked at again, to tell
'absent' from 'null' from 'wrong type'. All of it is narrow Spark expressions: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.jsonfields import (
    has_trailing_text, is_empty_json, json_object, json_struct, number_or_null,
)
from wattlake.functions.timecols import day_columns, iso_timestamp
from wattlake.schemas import BAD_DATA, SILVER_FLOWS, SILVER_MIX, SOURCES, STORAGE_FIELDS

MALFORMED_JSON = "MALFORMED_JSON"
DATA_NOT_A_LIST = "DATA_NOT_A_LIST"
RECORD_NOT_AN_OBJECT = "RECORD_NOT_AN_OBJECT"
MISSING_DATETIME = "MISSING_DATETIME"
BAD_DATETIME = "BAD_DATETIME"
MISSING_UPDATED_AT = "MISSING_UPDATED_AT"
BAD_UPDATED_AT = "BAD_UPDATED_AT"
MIX_NOT_AN_OBJECT = "MIX_NOT_AN_OBJECT"
FLOWS_NOT_AN_OBJECT = "FLOWS_NOT_AN_OBJECT"
BAD_POWER = "BAD_POWER"


def _document(raw_json: Column) -> Column:
    return json_struct(raw_json, "data: array<string>", broken="_broken")


def record_count(raw_json: Column) -> Column:
    """Number of records of a document; zero when ``data`` is absent, null or unreadable."""
    document = _document(raw_json)
    return F.when(document["_broken"].isNull(), F.coalesce(F.array_size(document["data"]), F.lit(0))).otherwise(
        F.lit(0)).cast("bigint")


def explode_records(bronze: DataFrame) -> DataFrame:
    """One row per record, plus one row for each document that cannot be read.

    Columns: ``process_ts, zone, record`` and ``document_error`` (null while the document is fine).
    """
    parsed = bronze.select(
        F.col("process_ts").cast("bigint"), "zone", "raw_json", _document(F.col("raw_json")).alias("doc"))
    top = json_object(F.col("raw_json"))
    document_error = (
        F.when(F.col("raw_json").isNull() | has_trailing_text(F.col("raw_json")), MALFORMED_JSON)
        .when(F.col("doc._broken").isNotNull(), F.when(top.isNull(), MALFORMED_JSON).otherwise(DATA_NOT_A_LIST))
        .when(F.col("doc.data").isNull() & F.map_contains_key(top, F.lit("data")), DATA_NOT_A_LIST)
    )
    checked = parsed.withColumn("document_error", document_error)
    # A broken document becomes a one-element list of its own text; absent data gives no element.
    elements = F.when(F.col("document_error").isNotNull(), F.array("raw_json")).otherwise(F.col("doc.data"))
    return checked.select("process_ts", "zone", "document_error", F.explode(elements).alias("record"))


def _parse_records(records: DataFrame, fields: str) -> DataFrame:
    """Adds the record's ``fields`` as ``rec`` and its two timestamps, with their texts."""
    wanted = f"datetime: string, updatedAt: string, {fields}"
    parsed = records.withColumn(
        "rec", F.when(F.col("document_error").isNull(), json_struct(F.col("record"), wanted)))
    return parsed.withColumns({
        "datetime_text": F.col("rec.datetime"),
        "datetime": iso_timestamp(F.col("rec.datetime")),
        "updated_at": iso_timestamp(F.col("rec.updatedAt")),
    })


def _time_error() -> Column:
    """First problem of the document, the record or its timestamps, in the order in which they are read."""
    return (
        F.when(F.col("document_error").isNotNull(), F.col("document_error"))
        .when(F.col("datetime_text").isNull(),
              F.when(json_object(F.col("record")).isNull(), RECORD_NOT_AN_OBJECT).otherwise(MISSING_DATETIME))
        .when(F.col("datetime").isNull(), BAD_DATETIME)
        .when(F.col("rec.updatedAt").isNull(), MISSING_UPDATED_AT)
        .when(F.col("updated_at").isNull(), BAD_UPDATED_AT)
    )


def _record_field(name: str) -> Column:
    """Text of a field of the record, from a second look at it."""
    return json_object(F.col("record"))[name]


_MIX_FIELDS = (
    "isEstimated: string, estimationMethod: string, mix: struct<"
    + ", ".join(f"{s}: string" for s in SOURCES)
    + "".join(f", `{g}`: struct<{', '.join(f'{x}: string' for x in sides)}>" for g, sides in STORAGE_FIELDS.items())
    + ", flows: struct<exports: string, imports: string>>"
)


def flatten_mix(bronze: DataFrame) -> DataFrame:
    """Mix documents to rows of the mix table plus ``error_code``, ``record`` and ``datetime_text``."""
    rows = _parse_records(explode_records(bronze), _MIX_FIELDS)
    mix = F.col("rec.mix")
    mix_error = F.when(
        mix.isNull() & F.map_contains_key(json_object(F.col("record")), F.lit("mix")), F.lit(MIX_NOT_AN_OBJECT))

    computed = {f"{s}_mw": number_or_null(mix[s]) for s in SOURCES}
    for group, sides in STORAGE_FIELDS.items():
        for side in sides:
            computed[f"{group.replace(' ', '_')}_{side}_mw"] = number_or_null(mix[group][side])
    computed |= {
        "flow_exports_mw": number_or_null(mix["flows"]["exports"]),
        "flow_imports_mw": number_or_null(mix["flows"]["imports"]),
        "is_estimated": F.col("rec.isEstimated").try_cast("boolean"),
        "estimation_method": F.col("rec.estimationMethod"),
        **day_columns(F.col("datetime")),
    }
    rows = rows.withColumn("error_code", F.coalesce(_time_error(), mix_error))
    row = F.struct(
        *[computed.get(n, F.col(n)).alias(n) for n in SILVER_MIX.fieldNames()], *_quarantine_columns())
    return rows.select(F.inline(F.array(row)))


def _quarantine_columns() -> list[Column]:
    """``error_code``, and what the quarantine keeps of a bad record; good rows carry no texts.

    Both functions generate their rows, although a mix record is one row: a filter on ``error_code``
    stays above a generator, while pushed further down it would parse every record again.
    """
    bad = F.col("error_code").isNotNull()
    return [F.col("error_code"), *[F.when(bad, F.col(c)).alias(c) for c in ("record", "datetime_text")]]


def _exchange_error(side: str) -> Column:
    """Error of one direction: not an object, or a value that is neither a number nor null."""
    entries = F.col(f"rec.{side}")
    bad_value = F.exists(F.map_values(entries), lambda v: v.isNotNull() & v.try_cast("double").isNull())
    return (
        F.when(entries.isNull(), F.when(~is_empty_json(_record_field(side)), FLOWS_NOT_AN_OBJECT))
        .when(bad_value, BAD_POWER)
    )


def flatten_flows(bronze: DataFrame) -> DataFrame:
    """Flow documents to one row per neighbour and direction, plus the quarantine columns.

    A record with any bad entry is quarantined as a whole.
    """
    rows = _parse_records(explode_records(bronze), "import: map<string,string>, export: map<string,string>")
    error = F.coalesce(_time_error(), _exchange_error("import"), _exchange_error("export"))
    rows = rows.withColumn("error_code", error)
    entry = "array<struct<neighbor_zone: string, direction: string, power_mw: double>>"

    def entries(side: str) -> Column:
        return F.coalesce(F.transform(
            F.map_entries(F.col(f"rec.{side}")),
            lambda e: F.struct(e["key"], F.lit(side), F.coalesce(e["value"].try_cast("double"), F.lit(0.0))),
        ), F.array()).cast(entry)

    nothing = F.array(F.struct(F.lit(None), F.lit(None), F.lit(None))).cast(entry)
    all_entries = F.when(F.col("error_code").isNotNull(), nothing).otherwise(
        F.concat(entries("import"), entries("export")))
    days = day_columns(F.col("datetime"))

    def row(e: Column) -> Column:
        columns = {n: e[n] for n in ("neighbor_zone", "direction", "power_mw")} | days
        return F.struct(
            *[columns.get(n, F.col(n)).alias(n) for n in SILVER_FLOWS.fieldNames()], *_quarantine_columns())

    return rows.select(F.inline(F.transform(all_entries, row)))


def good_rows(flat: DataFrame) -> DataFrame:
    return flat.where("error_code IS NULL").drop("error_code", "record", "datetime_text")


def bad_rows(flat: DataFrame) -> DataFrame:
    """Quarantined records in the shape of the bad-data tables, with their original text."""
    shown_time = F.when(F.col("datetime_text") == "", None).otherwise(F.col("datetime_text"))
    return flat.where("error_code IS NOT NULL").select(
        "process_ts",
        F.coalesce(shown_time, F.lit("unknown")).alias("datetime"),
        F.col("record").alias("raw_json"),
        F.col("error_code").alias("error_message"),
        F.current_timestamp().alias("created_at"),
    ).select(*BAD_DATA.fieldNames())
