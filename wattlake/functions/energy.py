"""Energy arithmetic and zone names."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Zone codes and their names. Other codes stand for themselves.
ZONE_NAMES = {
    "FR": "France",
    "DE": "Germany",
    "ES": "Spain",
    "IT-NO": "Italy North",
    "CH": "Switzerland",
    "BE": "Belgium",
    "GB": "Great Britain",
}


def row_sum(columns: Iterable[Column]) -> Column:
    """Sum across columns of a row, a null counting as zero."""
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in columns])


def relative_share(part: Column, total: Column) -> Column:
    """Percentage of ``part`` in ``total``; zero where the total is not positive or not a number."""
    share = F.when(total > 0, part / total * 100).otherwise(F.lit(0.0))
    return F.nanvl(share, F.lit(0.0))


def zone_name(code: Column, names: Mapping[str, str] = ZONE_NAMES) -> Column:
    """Name of a zone code by a literal lookup, so no join and no Python function is involved."""
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), code), code) if pairs else code


def with_zone_names(df: DataFrame, dimension: DataFrame, code: str, name: str) -> DataFrame:
    """The same lookup against a table ``(code, name)``; Spark broadcasts it if its size allows."""
    dim = dimension.select(F.col("code").alias(code), F.col("name").alias("__name"))
    return (
        df.join(dim, code, "left")
        .withColumn(name, F.coalesce("__name", code))
        .drop("__name")
    )
