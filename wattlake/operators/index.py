"""Incremental document index: change detection, upsert and snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def with_version(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``version``, the hash of the content."""
    return docs.withColumn("version", F.sha2(F.col(text), 256))


def index_delta(indexed: DataFrame, current: DataFrame, versions: bool = False) -> DataFrame:
    """``doc_id, change`` for all documents of both sides: new, changed, deleted or same. ``versions`` adds ``version``, the
    current one.

    Only ids and hashes are joined, never texts. Whether a side has a document does not depend on its version,
    which is null for a null text.
    """
    old = indexed.select("doc_id", F.struct(F.col("version")).alias("old"))
    new = current.select("doc_id", F.struct(F.col("version")).alias("new"))
    return old.join(new, "doc_id", "full_outer").select(
        "doc_id",
        F.when(F.col("old").isNull(), "new").when(F.col("new").isNull(), "deleted")
        .when(F.col("old.version").eqNullSafe(F.col("new.version")), "same").otherwise("changed").alias("change"),
        *[F.col("new.version")] * versions,
    )


def apply_delta(indexed: DataFrame, current: DataFrame) -> DataFrame:
    """The index after re-indexing changed documents only; applying it again changes nothing."""
    delta = index_delta(indexed, current)
    unchanged = indexed.join(delta.where("change = 'same'").select("doc_id"), "doc_id", "left_semi")
    renewed = current.join(delta.where("change IN ('new', 'changed')").select("doc_id"), "doc_id", "left_semi")
    return unchanged.select(*current.columns).unionByName(renewed)


def write_snapshot(index: DataFrame, path: str, snapshot_id: int) -> None:
    """Store the index under a snapshot id. Earlier snapshots stay; the same id is replaced."""
    index.write.mode("overwrite").parquet(f"{path}/snapshot_id={snapshot_id}")


def read_snapshot(spark: SparkSession, path: str, snapshot_id: int) -> DataFrame:
    """The index as it was; only that snapshot's folder is read."""
    return spark.read.parquet(path).where(F.col("snapshot_id") == snapshot_id).drop("snapshot_id")
