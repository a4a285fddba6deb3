"""Document intake from text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_documents(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """Text files as documents with their source metadata: a file each, or many split at ``separator``.

    Columns: ``doc_id, source_path, doc_type, version, ingested_at, text``. Id and version are hashes,
    so reading the same files again gives the same rows. ``doc_type`` is the file's ending.
    """
    reader = spark.read
    raw = reader.text(path, wholetext=True) if separator is None else reader.text(path, lineSep=separator)
    place = F.col("_metadata.file_path")
    version = F.sha2("value", 256)
    return raw.select(
        F.sha2(F.concat_ws("|", F.when(F.lit(separator is None), place), version), 256).alias("doc_id"),
        place.alias("source_path"),
        F.lower(F.regexp_extract(place, r"\.([A-Za-z0-9]+)$", 1)).alias("doc_type"),
        version.alias("version"),
        F.current_timestamp().alias("ingested_at"),
        F.col("value").alias("text"),
    )
