"""A vector index of document chunks that follows its documents and embeds only what is new.

Files are never changed. A commit's manifest names those that make up the index: folders of chunks with their vectors, folders
of chunks that are gone, folders of document versions, each with the number of the commit it came with. Any commit is a
snapshot, and going back is a commit with an old manifest; no row is copied for either.

An update compares documents by content hash, cuts only new and changed ones, and compares their chunks by hash. Only
texts whose hash the index has no vector for are embedded, once each; a chunk that moved, or that another document holds too,
takes the vector that is there. Ids and hashes are joined, never texts of unchanged documents; a new text is shuffled once, to find
its copies, and its vector stays where it is made unless several chunks hold the text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.operators.index import index_delta, with_version
from wattlake.sources.commits import CommitLog
from wattlake.sources.tables import union_all

COMPACT_AFTER = 32  # folders of chunks
# Keys up to this number (some 60 bytes each) go to texts and vectors instead of shuffling these to the keys.
MAX_BROADCAST_KEYS = 1 << 22

_EMPTY: dict = {"chunks": [], "gone": [], "docs": [], "embedded": 0}


def _few(keys: DataFrame) -> bool:
    return keys.count() <= MAX_BROADCAST_KEYS


def _reduced(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """``rows`` for an exact join with ``keys`` that follows, without most of those it drops while the keys are few: by 64-bit
    hashes, which take less than the keys."""
    if not _few(keys):
        return rows
    short = keys.select(F.xxhash64(column).alias("__short"))
    return rows.join(F.broadcast(short), F.xxhash64(rows[column]) == F.col("__short"), "left_semi")


class StoreConflict(RuntimeError):
    """Another writer committed to the index in between."""


class VectorStore:
    """The index below ``path``. ``cut`` turns ``doc_id, text`` into ``doc_id, pos, text``; ``embed`` adds ``embedding``."""

    def __init__(self, spark: SparkSession, path: str, cut: Callable[[DataFrame], DataFrame], embed: Callable[[DataFrame], DataFrame]):
        self.spark, self.path, self.cut, self.embed = spark, path, cut, embed
        self.log = CommitLog(spark, f"{path}/commits")

    # ------------------------------------------------------------ reading

    def manifest(self, snapshot: int | None = None) -> dict:
        number = self.log.last() if snapshot is None else snapshot
        return self.log.read(number) if number else _EMPTY

    def _read(self, folders: list, schema: str) -> DataFrame:
        """Rows of some folders with ``born``, the number of the commit they came with."""
        if not folders:
            return self.spark.createDataFrame([], f"{schema}, born bigint")
        return union_all([self.spark.read.parquet(f"{self.path}/{name}").withColumn("born", F.lit(born).cast("bigint"))
                          for born, name in folders])

    def _chunks(self, manifest: dict) -> DataFrame:
        """``item_id, doc_id, pos, hash, embedding`` of the chunks that are there: the last of each id, unless gone since."""
        rows = self._read(manifest["chunks"], "item_id string, doc_id bigint, pos int, hash string, embedding array<double>")
        rows = rows.where("item_id IS NOT NULL")  # else the vector of a text that several chunks hold
        gone = self._read(manifest["gone"], "item_id string").groupBy("item_id").agg(F.max("born").alias("until"))
        g = gone.withColumnRenamed("item_id", "gone_id")
        return rows.join(g, (F.col("item_id") == F.col("gone_id")) & (F.col("born") < F.col("until")), "left_anti")

    def items(self, snapshot: int | None = None) -> DataFrame:
        """The chunks of a snapshot, the last one by default."""
        return self._chunks(self.manifest(snapshot)).drop("born")

    def documents(self, snapshot: int | None = None) -> DataFrame:
        """``doc_id, version`` of the documents a snapshot holds."""
        rows = self._read(self.manifest(snapshot)["docs"], "doc_id bigint, version string, there boolean")
        last = rows.groupBy("doc_id").agg(F.max_by(F.struct("version", "there"), "born").alias("d"))
        return last.where("d.there").select("doc_id", "d.version")

    # ------------------------------------------------------------ writing

    def _write(self, df: DataFrame, kind: str) -> str:
        name = f"{kind}/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{name}")
        return name

    def _commit(self, base: int, manifest: dict) -> int:
        def allowed(last: int) -> None:
            if last != base:
                raise StoreConflict(f"commit {last} came after {base}")

        return self.log.add(manifest, allowed)

    def update(self, current: DataFrame) -> int:
        """Bring the index to ``current`` (``doc_id, text``, one row a document); returns the number of the new snapshot, or of
        the last one if nothing changed."""
        base = self.log.last()
        manifest, number = self.manifest(base), base + 1
        docs = current.select("doc_id", "text")
        delta = self._read_back(index_delta(self.documents(base), with_version(docs), versions=True), "delta")
        if delta.where("change <> 'same'").isEmpty():
            return base
        renewed = delta.where("change IN ('new', 'changed')").select("doc_id")
        versions = delta.where("change <> 'deleted'").join(renewed, "doc_id", "left_semi").select("doc_id", "version", F.lit(True).alias("there"))
        lost = delta.where("change = 'deleted'").select("doc_id", F.lit(None).cast("string").alias("version"), F.lit(False).alias("there"))
        if delta.where("change = 'same'").isEmpty():
            docs = docs.where("doc_id IS NOT NULL")
        else:
            docs = docs.join(F.broadcast(renewed) if _few(renewed) else renewed, "doc_id", "left_semi")
        cut = self._read_back(self.cut(docs).select(
            F.concat_ws("-", "doc_id", "pos").alias("item_id"), "doc_id", F.col("pos").cast("int").alias("pos"),
            F.sha2("text", 256).alias("hash"), "text"), "cut")
        ids, texts, held, gone = cut.select("item_id", "doc_id", "pos", "hash"), cut, None, []
        if manifest["chunks"]:
            live = self._chunks(manifest)
            touched = live.join(delta.where("change <> 'same'").select("doc_id"), "doc_id", "left_semi").select(
                "item_id", F.col("hash").alias("old_hash"))
            both = self._read_back(cut.select("item_id", "hash").join(touched, "item_id", "full_outer"), "both")
            # A chunk that changed is gone as well: what came before this commit does not count any more.
            gone = [[number, self._write(both.where("old_hash IS NOT NULL AND NOT hash <=> old_hash").select("item_id"), "gone")]]
            changed = both.where("hash IS NOT NULL AND NOT hash <=> old_hash").select("item_id")
            ids = self._read_back(ids.join(changed, "item_id", "left_semi"), "wanted")
            hashes = ids.select("hash").distinct()
            known = self._read_back(hashes.join(live.select("hash"), "hash", "left_semi"), "known")
            new = self._read_back(hashes.join(known, "hash", "left_anti"), "new")
            # A chunk with a new hash has changed, so all that hold the text are wanted.
            texts = _reduced(cut, new, "hash").join(new, "hash", "left_semi")
            held = _reduced(live.select("hash", "embedding"), known, "hash").dropDuplicates(["hash"])
        # A text that one chunk holds becomes that chunk's row where it is embedded. Only vectors of other texts move to their
        # chunks; their own rows have no item.
        once = texts.where("hash IS NOT NULL").groupBy("hash").agg(
            F.count(F.lit(1)).alias("n"), F.first(F.struct("item_id", "doc_id", "pos", "text")).alias("c"))
        only = [F.when(F.col("n") == 1, F.col(f"c.{name}")).alias(name) for name in ("item_id", "doc_id", "pos")]
        row = ["item_id", "doc_id", "pos", "hash", "embedding"]
        folder = self._write(self.embed(once.select("hash", *only, "c.text")).select(*row), "chunks")
        fresh = self.spark.read.parquet(f"{self.path}/{folder}")
        embedded = fresh.count()
        shared = ids.join(fresh.where("item_id IS NULL").select("hash", "embedding"), "hash").select(*row)
        if held is not None:
            shared = shared.unionByName(ids.join(held, "hash").select(*row))
        shared.write.mode("append").parquet(f"{self.path}/{folder}")
        return self._commit(base, {
            "chunks": [*manifest["chunks"], [number, folder]],
            "gone": [*manifest["gone"], *gone],
            "docs": [*manifest["docs"], [number, self._write(versions.unionByName(lost), "docs")]],
            "embedded": embedded})

    def _read_back(self, df: DataFrame, kind: str) -> DataFrame:
        """A step of an update, written once and read as often as needed."""
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{self._write(df, kind)}")

    def restore(self, snapshot: int) -> int:
        """Make an earlier snapshot the current one."""
        return self._commit(self.log.last(), {**self.manifest(snapshot), "embedded": 0})

    def compact(self) -> int:
        """Write the chunks and documents that are there to one folder each, when there are many."""
        base = self.log.last()
        if len(self.manifest(base)["chunks"]) <= COMPACT_AFTER:
            return base
        docs = self.documents(base).withColumn("there", F.lit(True))
        return self._commit(base, {"chunks": [[base + 1, self._write(self.items(base), "chunks")]], "gone": [],
                                   "docs": [[base + 1, self._write(docs, "docs")]], "embedded": 0})
