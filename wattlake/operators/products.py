"""Daily products. Each is one aggregation whose partial sums are built before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.functions.energy import relative_share, row_sum, zone_name
from wattlake.functions.timecols import day_columns
from wattlake.schemas import (
    FOSSIL_FREE, GOLD_EXPORTS, GOLD_IMPORTS, GOLD_MIX, RENEWABLE, SOURCES,
)


def _stamp(process_ts: int | Column) -> Column:
    return (process_ts if isinstance(process_ts, Column) else F.lit(process_ts)).cast("bigint")


def _hours_covered() -> Column:
    return F.count_distinct("datetime").cast("int").alias("hours_covered")


def daily_energy(silver_mix: DataFrame, hours_per_sample: float = 1.0) -> DataFrame:
    """MWh by zone, day and source, with the number of distinct timestamps seen."""
    return (
        silver_mix.groupBy("zone", F.to_date("datetime").alias("date"))
        .agg(
            *[F.coalesce(F.sum(f"{s}_mw") * hours_per_sample, F.lit(0.0)).alias(f"{s}_mwh") for s in SOURCES],
            _hours_covered(),
        )
    )


def daily_mix(silver_mix: DataFrame, process_ts: int | Column, hours_per_sample: float = 1.0) -> DataFrame:
    """Relative production mix per zone and day, in percent of the day's production.

    The two portfolio columns are sums of shares, although their names say 'avg'.
    """
    energy = daily_energy(silver_mix, hours_per_sample)
    total = row_sum(F.col(f"{s}_mwh") for s in SOURCES)
    shares = energy.withColumn("total_production_mwh", total).select(
        "zone", "date", "total_production_mwh", "hours_covered",
        *[relative_share(F.col(f"{s}_mwh"), F.col("total_production_mwh")).alias(f"{s}_pct") for s in SOURCES],
    )
    return shares.withColumns({
        "process_ts": _stamp(process_ts),
        "zone_name": zone_name(F.col("zone")),
        "fossil_free_avg_pct": row_sum(F.col(f"{s}_pct") for s in FOSSIL_FREE),
        "renewable_avg_pct": row_sum(F.col(f"{s}_pct") for s in RENEWABLE),
        **day_columns(F.col("date")),
    }).select(*GOLD_MIX.fieldNames())


def daily_net_flows(silver_flows: DataFrame, process_ts: int | Column,
                    hours_per_sample: float = 1.0) -> DataFrame:
    """Gross import, gross export and net flow per zone, neighbour and day."""
    def gross(direction: str) -> Column:
        power = F.when(F.col("direction") == direction, F.col("power_mw"))
        return F.coalesce(F.sum(power) * hours_per_sample, F.lit(0.0))

    return (
        silver_flows.groupBy("zone", "neighbor_zone", F.to_date("datetime").alias("date"))
        .agg(
            gross("import").alias("gross_import_mwh"),
            gross("export").alias("gross_export_mwh"),
            _hours_covered(),
        )
        .withColumns({
            "net_flow": F.col("gross_import_mwh") - F.col("gross_export_mwh"),
            "process_ts": _stamp(process_ts),
            "zone_name": zone_name(F.col("zone")),
            "neighbor_zone_name": zone_name(F.col("neighbor_zone")),
            **day_columns(F.col("date")),
        })
    )


def net_imports(net_flows: DataFrame) -> DataFrame:
    """Days on which a zone took more from a neighbour than it gave."""
    return (
        net_flows.where("net_flow > 0")
        .withColumnsRenamed({"neighbor_zone": "source_zone", "neighbor_zone_name": "source_zone_name",
                             "net_flow": "import_mwh"})
        .select(*GOLD_IMPORTS.fieldNames())
    )


def net_exports(net_flows: DataFrame) -> DataFrame:
    """Days on which a zone gave more to a neighbour than it took. A net of zero is in neither product."""
    return (
        net_flows.where("net_flow < 0")
        .withColumn("export_mwh", -F.col("net_flow"))
        .withColumnsRenamed({"neighbor_zone": "destination_zone",
                             "neighbor_zone_name": "destination_zone_name"})
        .select(*GOLD_EXPORTS.fieldNames())
    )


def coverage(gold: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Data range per zone: first and last day, days seen, incomplete and missing days, staleness."""
    as_of = F.current_date() if as_of is None else as_of
    span = F.datediff(F.max("date"), F.min("date")) + 1
    return gold.groupBy("zone").agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count(F.lit(1)).alias("n_days"),
        F.sum(F.when(F.col("hours_covered") < 24, 1).otherwise(0)).cast("bigint").alias("incomplete_days"),
        (span - F.count(F.lit(1))).cast("bigint").alias("missing_days"),
    ).withColumn("stale_days", F.datediff(as_of, F.col("last_date")).cast("bigint"))


def missing_hours(readings: DataFrame, first: Column, last: Column) -> DataFrame:
    """Hours in ``[first, last]`` for which a zone has no reading.

    One pass: the hours present are gathered per zone, at most one entry per hour of the window, and
    taken away from the expected ones.
    """
    hour = F.date_trunc("hour", "datetime")
    per_zone = readings.groupBy("zone").agg(F.collect_set(F.when(hour.between(first, last), hour)).alias("present"))
    expected = F.sequence(first, last, F.expr("INTERVAL 1 HOUR"))
    return per_zone.select("zone", F.explode(F.array_except(expected, F.col("present"))).alias("datetime"))


def missing_intervals(readings: DataFrame, zones: DataFrame, first: Column, last: Column) -> DataFrame:
    """Stretches of hours in ``[first, last]`` without a reading: ``zone, gap_start, gap_end, n_hours``; ``gap_end`` is the last
    hour missing. ``zones`` are those expected, so that a zone without any reading is one whole gap.

    Hours present are made distinct before they meet, at most one for each zone and hour, and each is compared with the one
    before it; missing hours are never listed."""
    hour = F.date_trunc("hour", "datetime")
    present = readings.where(hour.between(first, last)).select("zone", hour.alias("at")).distinct()
    one = F.expr("INTERVAL 1 HOUR")
    # An hour before the window and one behind it close the gaps at both ends.
    edges = zones.select("zone").distinct().select("zone", F.explode(F.array(first - one, last + one)).alias("at"))
    before = F.lag("at").over(Window.partitionBy("zone").orderBy("at"))
    known = present.join(zones.select("zone").distinct(), "zone", "left_semi")
    gaps = known.unionByName(edges).withColumn("before", before)
    hours = ((F.unix_seconds("at") - F.unix_seconds("before")) / 3600).cast("bigint") - 1
    return gaps.where(hours > 0).select(
        "zone", (F.col("before") + one).alias("gap_start"), (F.col("at") - one).alias("gap_end"), hours.alias("n_hours"))
