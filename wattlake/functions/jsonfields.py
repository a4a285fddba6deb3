"""JSON expressions that keep 'missing', 'null' and 'wrong type' apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_object(text: Column) -> Column:
    """One JSON object as a map from key to the text of its value; null for anything else."""
    return F.from_json(text, "map<string,string>", {"allowSingleQuotes": "false"})


def json_struct(text: Column, schema: str, broken: str | None = None) -> Column:
    """One JSON object as a struct; ``broken`` names a string field set if any part did not fit."""
    options = {"allowSingleQuotes": "false"}
    if broken is not None:
        options["columnNameOfCorruptRecord"] = broken
        schema = f"{schema}, {broken} string"
    return F.from_json(text, f"struct<{schema}>", options)


def has_trailing_text(text: Column) -> Column:
    """True when something follows the first JSON value, which ``from_json`` alone would not notice.

    The length function knows no NaN or Infinity, so texts with those are not judged.
    """
    length = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    return ~length.eqNullSafe(F.lit(1)) & ~text.rlike("NaN|Infinity")


def number_or_null(text: Column) -> Column:
    return text.try_cast("double")


def is_empty_json(text: Column) -> Column:
    """True for the values that count as 'nothing there': null, empty text, list or object, zero, false."""
    return text.isNull() | F.trim(text).isin("", "{}", "[]", "0", "0.0", "false")
