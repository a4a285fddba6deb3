"""Business keys: latest row per key, duplicate detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """Rows share a key that must be unique."""


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  settle_ties: bool = False) -> DataFrame:
    """One row per key: the one with the greatest ``order`` columns.

    ``settle_ties`` breaks equal ones by a hash of the row, so that every run keeps the same row.
    The rank filter plans as a group limit on both sides of the shuffle, so every map task sends at
    most one row per key and a key holding a third of all rows costs one row per task.
    """
    newest_first = [F.col(c).desc_nulls_last() for c in order]
    if settle_ties:
        newest_first.append(F.xxhash64(*[c for c in df.columns if c not in keys]).desc())
    ranked = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first)))
    return ranked.where(F.col("__rn") == 1).drop("__rn")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def assert_unique_keys(df: DataFrame, keys: Sequence[str], label: str) -> None:
    sample = duplicate_keys(df, keys).limit(3).collect()
    if sample:
        shown = "; ".join(str(tuple(r[k] for k in keys)) for r in sample)
        raise DuplicateKeyError(f"{label}: duplicate keys for {list(keys)}, such as {shown}")
