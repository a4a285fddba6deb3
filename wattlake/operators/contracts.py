"""Data contracts: a table schema plus named row rules, checked in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake import schemas as S

_TOLERANCE = 1e-9  # summed percentages may pass 100 by floating-point error


class ContractViolation(ValueError):
    """Rows break a contract that allows none; ``counts`` holds rows per rule."""

    def __init__(self, label: str, counts: Mapping[str, int]):
        super().__init__(f"{label}: " + ", ".join(f"{k}={v}" for k, v in sorted(counts.items())))
        self.counts = dict(counts)


@dataclass(frozen=True)
class Contract:
    """``ranges`` maps a column to inclusive bounds (either may be None); ``allowed`` to its values.

    Nulls break a contract only in ``required`` columns. Extra columns are let through.
    """

    schema: T.StructType
    required: Sequence[str]
    ranges: Mapping[str, tuple[float | None, float | None]] = field(default_factory=dict)
    allowed: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def _rules(self) -> dict[str, Column]:
        """Rule name to the condition under which a row breaks it."""
        rules = {f"not_null:{c}": F.col(c).isNull() for c in self.required}
        for c, values in self.allowed.items():
            rules[f"allowed:{c}"] = ~F.col(c).isin(list(values))
        for c, (low, high) in self.ranges.items():
            outside = F.lit(False)
            if low is not None:
                outside = outside | (F.col(c) < low)
            if high is not None:
                outside = outside | (F.col(c) > high + _TOLERANCE)
            rules[f"range:{c}"] = outside
        return rules

    def check(self, df: DataFrame) -> DataFrame:
        """Coerce to the schema and add ``violations``, the names of the rules each row breaks."""
        present = dict(df.dtypes)
        coerced: dict[str, Column] = {}
        failed_casts: list[Column] = []
        for f in self.schema.fields:
            if f.name not in present:
                coerced[f.name] = F.lit(None).cast(f.dataType)
            elif df.schema[f.name].dataType != f.dataType:
                coerced[f.name] = F.col(f.name).try_cast(f.dataType)
                failed_casts.append(F.when(
                    F.col(f.name).isNotNull() & coerced[f.name].isNull(), F.lit(f"type:{f.name}")
                ))
        kept = F.array_compact(F.array(*failed_casts)) if failed_casts else F.lit(None)
        typed = df.withColumn("__casts", kept.cast("array<string>")).withColumns(coerced)
        broken = F.array_compact(F.array(*[
            F.when(F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in self._rules().items()
        ]))
        return typed.withColumn(
            "violations", F.concat(F.coalesce("__casts", F.array().cast("array<string>")), broken)
        ).drop("__casts")

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(rows that keep the contract, rows that break it with ``violations``)."""
        checked = self.check(df)
        return checked.where(F.size("violations") == 0).drop("violations"), checked.where(F.size("violations") > 0)

    def enforce(self, df: DataFrame, label: str) -> DataFrame:
        """Fail if any row breaks the contract."""
        checked = self.check(df)
        counts = {r.rule: r.n_rows for r in violation_counts(checked).collect()}
        if counts:
            raise ContractViolation(label, counts)
        return checked.drop("violations")


def violation_counts(checked: DataFrame) -> DataFrame:
    return (
        checked.select(F.explode("violations").alias("rule"))
        .groupBy("rule").agg(F.count(F.lit(1)).alias("n_rows"))
    )


def violating_rows_as_bad_data(broken: DataFrame) -> DataFrame:
    """Rows that break a contract in the shape of the bad-data tables."""
    columns = [c for c in broken.columns if c != "violations"]
    return broken.select(
        "process_ts",
        F.coalesce(F.col("datetime").cast("string"), F.lit("unknown")).alias("datetime"),
        F.to_json(F.struct(*columns)).alias("raw_json"),
        F.array_join("violations", ",").alias("error_message"),
        F.current_timestamp().alias("created_at"),
    )


_STAMPED = ["process_ts", "zone", "datetime", "updated_at"]
SILVER_MIX = Contract(S.SILVER_MIX, [*_STAMPED, *S.DAY_COLUMNS])
SILVER_FLOWS = Contract(
    S.SILVER_FLOWS, S.SILVER_FLOWS.fieldNames(), allowed={"direction": ["import", "export"]}
)

_PCT = [f"{s}_pct" for s in S.PUBLISHED_SOURCES] + ["fossil_free_avg_pct", "renewable_avg_pct"]
GOLD_MIX = Contract(
    S.GOLD_MIX,
    [c for c in S.GOLD_MIX.fieldNames() if c not in _PCT],
    ranges={**{c: (0.0, 100.0) for c in _PCT}, "total_production_mwh": (0.0, None), "hours_covered": (1, 24)},
)
GOLD_IMPORTS = Contract(
    S.GOLD_IMPORTS, S.GOLD_IMPORTS.fieldNames(), ranges={"import_mwh": (0.0, None), "hours_covered": (1, 24)}
)
GOLD_EXPORTS = Contract(
    S.GOLD_EXPORTS, S.GOLD_EXPORTS.fieldNames(), ranges={"export_mwh": (0.0, None), "hours_covered": (1, 24)}
)
