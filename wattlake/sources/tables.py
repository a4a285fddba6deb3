"""Partitioned Parquet tables: scans, appends, key upserts and day replacement.

Two rules keep the writes safe to repeat: every write names the rows it replaces by key or by
day, and only the partitions it touches are rewritten, as one publication that a stop cannot leave half done.
Output is rebalanced by partition, so one very large day is split over many tasks and small days share a file.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager, nullcontext

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.operators.keys import assert_unique_keys, latest_by_key
from wattlake.schemas import DAY_COLUMNS
from wattlake.sources.commits import CommitLog
from wattlake.sources.files import exists, remove_files  # noqa: F401  (part of this module's interface)
from wattlake.sources.publish import Publication, recover

Day = tuple[int, int, int]


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there. Any other storage error is raised, not read as 'missing'."""
    return exists(spark, path)


# ---------------------------------------------------------------- scans

def read_table(spark: SparkSession, path: str, schema: T.StructType,
               columns: Sequence[str] | None = None) -> DataFrame:
    """A lazy scan of the table, empty when it does not exist yet."""
    if table_exists(spark, path):
        df = spark.read.schema(schema).parquet(path)
    else:
        df = spark.createDataFrame([], schema)
    return df.select(*columns) if columns else df


def day_number(year="year", month="month", day="day"):
    """One integer per day made of partition columns only, so a filter on it prunes folders."""
    return F.col(year) * 10000 + F.col(month) * 100 + F.col(day)


def only_days(df: DataFrame, days: Sequence[Day]) -> DataFrame:
    """Rows of the given days; no days means no rows."""
    if not days:
        return df.limit(0)
    return df.where(day_number().isin([y * 10000 + m * 100 + d for y, m, d in days]))


def read_days(spark: SparkSession, path: str, schema: T.StructType, days: Sequence[Day]) -> DataFrame:
    return only_days(read_table(spark, path, schema), days)


def only_batches(df: DataFrame, batches: DataFrame | Sequence[int]) -> DataFrame:
    """Rows of the given batch ids, as a list or as a frame with a ``process_ts`` column."""
    if isinstance(batches, DataFrame):
        return df.join(batches.select("process_ts").distinct(), "process_ts", "left_semi")
    return df.where(F.col("process_ts").isin(list(batches)))


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of a scan that has far fewer splits than there are cores.

    For work that is heavy per row. Large inputs have splits enough and are left as they are, so
    nothing is shuffled at scale. ``df`` must be a scan with narrow steps only.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 <= cores else df


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)


def affected_days_frame(*frames: DataFrame) -> DataFrame:
    """Distinct days over several frames."""
    parts = [f.select(*DAY_COLUMNS).distinct() for f in frames]
    days = parts[0]
    for part in parts[1:]:
        days = days.unionByName(part)
    return days.distinct()


def affected_days(*frames: DataFrame) -> list[Day]:
    """The same as a sorted list. It holds one entry per calendar day, however large the frames are."""
    rows = affected_days_frame(*frames).collect()
    return sorted((r.year, r.month, r.day) for r in rows)


def rows_per_day(df: DataFrame) -> dict[Day, int]:
    """Number of rows of each day that occurs: the days to rewrite and the size of the batch in one job."""
    counts = df.groupBy(*DAY_COLUMNS).agg(F.count(F.lit(1)).alias("n")).collect()
    return {(r.year, r.month, r.day): r.n for r in counts}


# ---------------------------------------------------------------- combining frames

def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name; missing columns become null and types widen."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


# ---------------------------------------------------------------- writes

@contextmanager
def persisted(*frames: DataFrame) -> Iterator[list[DataFrame]]:
    """Keep frames that several jobs read; those kept by the caller already are left alone."""
    mine = [f for f in frames if not f.is_cached]
    for f in mine:
        f.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield list(frames)
    finally:
        for f in mine:
            f.unpersist()


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (), spread: bool = True) -> None:
    """Append to a table. ``spread=False`` is for rows that all fall into one partition: every task then
    writes its own file there, and nothing is shuffled."""
    rows = df.hint("rebalance", *partition_by) if partition_by and spread else df
    rows.write.mode("append").partitionBy(*partition_by).parquet(path)


def append_if_any(df: DataFrame, path: str) -> None:
    """Append without leaving empty files or an empty table behind."""
    if not df.isEmpty():
        append(df, path)


def own_publication(spark: SparkSession, path: str) -> Publication:
    """A publication of a table that belongs to no lake, with its log and stage in hidden folders of the table. What an
    earlier one left undone is finished first."""
    log = CommitLog(spark, f"{path}/_commits")
    recover(spark, log, f"{path}/_staged", "table")
    return Publication(spark, log, f"{path}/_staged", "table")


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str] = DAY_COLUMNS) -> None:
    """Replace exactly the partitions that occur in ``df``."""
    publication = own_publication(df.sparkSession, path)
    publication.replace(df, path, partition_by)
    publication.commit()


def merge_by_keys(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
                  keep: str = "incoming") -> DataFrame:
    """Existing rows and incoming rows with one row per key.

    ``keep='incoming'`` lets every incoming row win; ``keep='latest'`` compares ``updated_at`` and
    lets the incoming row win ties.
    """
    if keep == "incoming":
        remaining = existing.join(incoming.select(*keys), list(keys), "left_anti")
        return union_all([remaining, incoming])
    if keep != "latest":
        raise ValueError(f"unknown keep rule {keep!r}")
    both = union_all([existing.withColumn("__rank", F.lit(0)), incoming.withColumn("__rank", F.lit(1))])
    return latest_by_key(both, keys, ["updated_at", "__rank"]).drop("__rank")


def upsert_by_keys(incoming: DataFrame, path: str, keys: Sequence[str], schema: T.StructType,
                   keep: str = "incoming", days: Sequence[Day] | None = None, known_unique: bool = False,
                   check_table: bool = True, publication: Publication | None = None) -> list[Day]:
    """Upsert into a table partitioned by day; returns the days rewritten.

    A key decides its day, because the partition columns derive from the key's timestamp. Rows
    outside the incoming days can therefore not be replaced, and only those days are read back.
    Pass ``days`` if they are known already, and ``known_unique`` if ``incoming`` comes out of an
    operator that leaves one row per key. ``check_table=False`` trusts the table's keys to be unique,
    which they are while nothing else writes to it, and saves a scan of the keys of those days.
    The days become part of ``publication``, which the caller commits, or are published at once.
    """
    spark = incoming.sparkSession
    mine = None if publication else own_publication(spark, path)
    with persisted(incoming):
        days = affected_days(incoming) if days is None else sorted(days)
        if not days:
            return []
        if not known_unique:
            assert_unique_keys(incoming, keys, "incoming rows")
        merged = incoming
        if table_exists(spark, path):
            existing = read_days(spark, path, schema, days)
            if check_table:
                # Merging keeps the two sides apart, so only rows already in the table can still repeat a key.
                assert_unique_keys(existing, keys, "table rows")
            merged = merge_by_keys(existing, incoming, keys, keep)
        (publication or mine).replace(merged.select(*schema.fieldNames()), path)
    if mine:
        mine.commit()
    return days


def replace_days(df: DataFrame, path: str, days: Sequence[Day], keys: Sequence[str], filled: Iterable[Day] | None = None,
                 known_unique: bool = False, publication: Publication | None = None) -> None:
    """Make ``df`` the whole content of the given days; days without rows become empty.

    ``filled`` are the days that occur in ``df``, if known already; ``known_unique`` and ``publication`` as for the upsert.
    """
    if not days:
        return
    mine = None if publication else own_publication(df.sparkSession, path)
    read_once = known_unique and filled is not None
    with nullcontext() if read_once else persisted(df):
        if not known_unique:
            assert_unique_keys(df, keys, "incoming rows")
        filled = set(affected_days(df) if filled is None else filled)
        if not filled <= set(days):
            raise ValueError(f"rows outside the days to replace: {sorted(filled - set(days))[:3]}")
        (publication or mine).replace(df, path, remove=[f"year={y}/month={m}/day={d}" for y, m, d in days])
    if mine:
        mine.commit()


def write_extract(df: DataFrame, root: str, layer: str, table: str, process_ts: int) -> str:
    """A Parquet extract of one batch: ``root/layer/year/month/day/process_ts/table``.

    The day is that of the batch id.
    """
    from datetime import datetime, timezone

    day = datetime.fromtimestamp(process_ts / 1000, timezone.utc)
    path = f"{root}/{layer}/{day:%Y}/{day:%m}/{day:%d}/{process_ts}/{table}"
    df.write.mode("overwrite").parquet(path)
    return path
