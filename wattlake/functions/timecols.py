"""Time expressions. The session time zone is UTC (see ``wattlake.session``)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

_USUAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-](0\d|1[0-7]):[0-5]\d)?$"
# date; then optionally any one separator, hour, minute, second, fraction; then optionally an offset
_GENERAL = (
    r"^(\d{4})(-?)(\d{2})\2(\d{2})"
    r"(?:.(\d{2})(?:(:?)(\d{2})(?:\6(\d{2})(?:[.,](\d+))?)?)?"
    r"(?:Z|([+-])(\d{2})(?:(:?)(\d{2})(?:\12(\d{2}))?)?)?)?$"
)
_GENERAL_GROUPS = "$1|$3|$4|$5|$7|$8|$9|$10|$11|$13|$14"


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text to a timestamp; null when it is not ISO-8601.

    Accepts extended and basic forms, any one-character separator, and texts without an offset
    (taken as UTC). The guard is needed because a plain cast would also take ``'2026'``. Offsets are
    applied by arithmetic, since a cast knows none beyond 18 hours.
    """
    def rebuilt(g: Column) -> Column:
        def part(i: int) -> Column:
            return F.when(g[i] == "", F.lit("00")).otherwise(g[i])

        local = F.concat(
            g[0], F.lit("-"), g[1], F.lit("-"), g[2], F.lit("T"), part(3), F.lit(":"), part(4), F.lit(":"), part(5),
            F.lit("."), F.substring(part(6), 1, 6), F.lit("Z"),
        ).try_cast("timestamp")
        offset = part(8).cast("bigint") * 3600 + part(9).cast("bigint") * 60 + part(10).cast("bigint")
        signed = F.when(g[7] == "-", -offset).otherwise(offset)
        return F.when(offset < 86_400, F.timestamp_micros(F.unix_micros(local) - signed * 1_000_000))

    groups = F.split(F.regexp_replace(text, _GENERAL, _GENERAL_GROUPS), r"\|", -1)
    return (
        F.when(text.rlike(_USUAL), text.try_cast("timestamp"))
        .when(text.rlike(_GENERAL), F.transform(F.array(groups), rebuilt)[0])
    )


def floor_to_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def process_ts_to_timestamp(process_ts: Column) -> Column:
    """A batch id is the epoch time in milliseconds."""
    return F.timestamp_millis(process_ts)


def utc(moment: datetime) -> Column:
    """A timezone-aware moment as a timestamp literal."""
    return F.timestamp_micros(F.lit(int(moment.timestamp() * 1_000_000)))


def day_columns(ts: Column) -> dict[str, Column]:
    """The partition columns of a timestamp or date."""
    return {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)}
