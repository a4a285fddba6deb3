"""Raw payload files and their envelope, the rows of the bronze tables."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.functions.timecols import day_columns
from wattlake.operators.flatten import record_count
from wattlake.schemas import BRONZE
from wattlake.sources.tables import table_exists, union_all


def read_payloads(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Raw documents as ``raw_json``: a file each, or a line each."""
    return spark.read.text(path, wholetext=not one_per_line).withColumnRenamed("value", "raw_json")


# A listing or scan of many small files takes some tasks a core, not one for each folder or handful of files. Folders beside each
# other are listed by tasks even if they are few.
_OPEN_COST = 64 << 10
_LISTING_TASKS_PER_CORE = 4
_LISTED_ON_DRIVER = 4
_THRESHOLD = "spark.sql.sources.parallelPartitionDiscovery.threshold"
_IGNORE_LOCALITY = "spark.sql.sources.ignoreDataLocality"


@contextmanager
def many_small_files(spark: SparkSession) -> Iterator[None]:
    """Settings for listing and reading folders of very many small files, for the jobs started inside. Of a session that sets
    them lower already, its own are kept. Where the blocks of such files lie is not asked, as a task reads many."""
    wanted = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": spark.sparkContext.defaultParallelism * _LISTING_TASKS_PER_CORE,
              _THRESHOLD: _LISTED_ON_DRIVER,
              "spark.sql.files.openCostInBytes": _OPEN_COST}
    before = {key: spark.conf.get(key) for key in [*wanted, _IGNORE_LOCALITY]}
    try:
        for key, value in wanted.items():
            if not before[key].isdigit() or int(before[key]) > value:
                spark.conf.set(key, str(value))
        spark.conf.set(_IGNORE_LOCALITY, "true")
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


LANDED = "path STRING, changed TIMESTAMP, process_ts BIGINT"


@dataclass(frozen=True)
class NewFiles:
    """Files of one listing that no finished batch has landed.

    Those changed after all files landed before are read through the listing as it is. Only the others, ``late``, are on the driver
    as (path, micros) and read by name, and so are the compressed ones, which need the text reader."""

    recent: DataFrame  # path, name, changed, content
    late: list
    endings: list[str]

    def __len__(self) -> int:
        return len(self.late) + self.recent.count()

    def __bool__(self) -> bool:
        return bool(self.late) or not self.recent.isEmpty()


def _list(spark: SparkSession, path: str) -> DataFrame:
    """All files below ``path``, listed by tasks, or by the driver if there are more than tasks may send it at once."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        return reader.load(path)
    except Py4JJavaError as error:
        if "spark.driver.maxResultSize" not in str(error):
            raise
    before = spark.conf.get(_THRESHOLD)
    try:
        spark.conf.set(_THRESHOLD, str((1 << 31) - 1))
        return reader.load(path)
    finally:
        spark.conf.set(_THRESHOLD, before)


def new_files(spark: SparkSession, path: str, landed: str, finished: DataFrame) -> NewFiles:
    """Files below ``path`` that no batch among ``finished`` (``process_ts``) has landed. Contents are not read.

    What the table of landed files says of other batches does not count: their rows never get to silver. The listing is on the driver,
    as Spark's always is.
    """
    listed = _list(spark, path)
    # The time is that of the listing, so files can be left out before any task opens them.
    files = listed.select("path", F.col("_metadata.file_name").alias("name"),
                          F.col("_metadata.file_modification_time").alias("changed"), "content")
    endings = _compressed_endings(spark)
    if not table_exists(spark, landed):
        return NewFiles(files, [], endings)
    known = spark.read.schema(LANDED).parquet(landed).join(finished, "process_ts", "left_semi")
    newest = known.agg(F.unix_micros(F.max("changed"))).first()[0]
    if newest is None:
        return NewFiles(files, [], endings)
    is_recent = F.col("changed") > F.timestamp_micros(F.lit(newest))
    late = files.where(~is_recent).select("path", "changed").join(known, ["path", "changed"], "left_anti")
    return NewFiles(files.where(is_recent), late.select("path", F.unix_micros("changed")).collect(), endings)


def read_files(spark: SparkSession, files: NewFiles) -> DataFrame:
    """``raw_json`` of the given files, a document each."""
    packed = F.lit(False)
    for ending in files.endings:
        packed |= F.col("name").endswith(ending)
    text = F.col("content").cast("string").alias("raw_json")
    parts = [files.recent.where(~packed).select(text)]
    late = [path for path, _ in files.late]
    named = [r.path for r in files.recent.where(packed).select("path").collect()]
    named += [path for path in late if path.endswith(tuple(files.endings))]
    plain = [path for path in late if not path.endswith(tuple(files.endings))]
    if plain:
        parts.append(spark.read.format("binaryFile").load([as_literal(path) for path in plain]).select(text))
    if named:
        by_name = spark.read.text([as_literal(path) for path in named], wholetext=True)
        parts.append(by_name.withColumnRenamed("value", "raw_json"))
    return union_all(parts)


def _compressed_endings(spark: SparkSession) -> list[str]:
    """Endings of the files that the text reader unpacks."""
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    codecs = hadoop.io.compress.CompressionCodecFactory.getCodecClasses(conf)
    return [hadoop.util.ReflectionUtils.newInstance(codec, conf).getDefaultExtension() for codec in codecs]


def as_literal(path: str) -> str:
    """A path that means itself to readers that take patterns, whatever characters are in it."""
    return re.sub(r"([\\*?{}\[\]])", r"\\\1", path)


def remember_files(spark: SparkSession, files: NewFiles, landed: str, process_ts: int) -> None:
    rows = files.recent.select("path", "changed")
    if files.late:
        late = spark.createDataFrame(files.late, "path STRING, micros BIGINT")
        rows = rows.unionByName(late.select("path", F.timestamp_micros("micros").alias("changed")))
    rows = rows.withColumn("process_ts", F.lit(process_ts).cast("bigint"))
    rows.hint("rebalance").write.mode("append").parquet(landed)


def source_url(base_url: str, endpoint: str, zone: Column, start: Column, end: Column) -> Column:
    def iso(ts: Column) -> Column:
        return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")

    return F.concat(
        F.lit(f"{base_url}/{endpoint}/past-range?zone="), zone,
        F.lit("&start="), iso(start), F.lit("&end="), iso(end),
    )


def envelope(payloads: DataFrame, *, process_ts: int | Column, ingested_at: Column, base_url: str,
             endpoint: str, start: Column, end: Column, zone: Column | None = None) -> DataFrame:
    """Payloads with their ingestion metadata. The zone is that given, or the one asked for if ``payloads`` says it in a column
    ``zone``, as a folder ``zone=...`` does, or else the payload's own."""
    stamp = process_ts if isinstance(process_ts, Column) else F.lit(process_ts)
    own = F.get_json_object("raw_json", "$.zone")
    asked = F.coalesce(F.col("zone").cast("string"), own) if "zone" in payloads.columns else own
    zone = asked if zone is None else zone
    return payloads.select(
        stamp.cast("bigint").alias("process_ts"),
        ingested_at.alias("ingestion_timestamp"),
        source_url(base_url, endpoint, zone, start, end).alias("source_url"),
        zone.alias("zone"),
        start.alias("range_start"),
        end.alias("range_end"),
        "raw_json",
        record_count(F.col("raw_json")).alias("record_count"),
        *[c.alias(n) for n, c in day_columns(ingested_at).items()],
    ).select(*BRONZE.fieldNames())
