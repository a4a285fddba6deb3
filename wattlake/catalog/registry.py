"""Registration of named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, folder) under its own name, with its equivalent SQL."""
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            return present(function(spark, sf_dir))

        run.__name__, run.__doc__ = function.__name__, function.__doc__
        _QUERIES[function.__name__] = run
        if sql is not None:
            _SQL[function.__name__] = sql
        return function
    return register


def present(df: DataFrame) -> DataFrame:
    """Results in a form two engines can agree on: six decimals, dates and times as text."""
    shown = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            column = F.round(column, 6)
        elif isinstance(f.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        shown.append(column.alias(f.name))
    return df.select(*shown)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
