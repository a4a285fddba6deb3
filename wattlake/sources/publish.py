"""Publishing partitions of several tables as one change that survives a stop at any point.

First everything is staged: the new content of each partition is written to a folder of its own beside the tables, which stay
as they are. Then one commit names all of it; from there on the change counts as made. Applying it moves each
staged folder to the partition's place and deletes partitions that became empty, and a last commit says that it is done. A
driver lost before the commit leaves tables untouched. One lost after it leaves a commit without its end, and the next
writer applies the rest: a staged folder that is still there has not been moved, one that is gone has.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from wattlake.schemas import DAY_COLUMNS
from wattlake.sources.commits import CommitLog
from wattlake.sources.files import exists, list_folders, list_names, move, remove_files


class Publication:
    """One change. ``owner`` is the writer it belongs to: only that one, of which a single one is alive, may finish it."""

    def __init__(self, spark: SparkSession, log: CommitLog, staging: str, owner: str):
        self.spark, self.log, self.owner = spark, log, owner
        self.name = uuid.uuid4().hex
        self.staging = f"{staging}/{owner}/{self.name}"
        self.moves: list[dict] = []

    def replace(self, df: DataFrame, table: str, partition_by: Sequence[str] = DAY_COLUMNS,
                remove: Sequence[str] = ()) -> None:
        """Stage ``df`` as the whole content of the partitions it has rows for. Those of ``remove`` it has none for go."""
        staged = f"{self.staging}/{len(self.moves)}-{uuid.uuid4().hex}"
        df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(staged)
        parts = list_folders(self.spark, staged, len(partition_by))
        self.moves.append({"table": table, "staged": staged, "parts": sorted(parts), "removed": sorted(set(remove) - set(parts))})

    def append(self, df: DataFrame, table: str) -> None:
        """Stage the rows of ``df`` as new files of an unpartitioned table."""
        staged = f"{self.staging}/{len(self.moves)}-{uuid.uuid4().hex}"
        df.write.parquet(staged)
        files = [n for n in list_names(self.spark, staged) if n[0] not in "._"]
        self.moves.append({"table": table, "staged": staged, "files": sorted(files), "name": self.name})

    def prepare(self, then: Sequence[dict] = ()) -> dict | None:
        """Commit to the change; from here on it will be made. ``then`` are changes for the log that hold once it is made."""
        if not (self.moves or then):
            return None
        record = {"name": self.name, "owner": self.owner, "staging": self.staging, "moves": self.moves, "then": list(then)}
        self.log.add({"publish": record})
        return record

    def commit(self, then: Sequence[dict] = ()) -> None:
        record = self.prepare(then)
        if record:
            finish(self.spark, self.log, record)


def move_part(spark: SparkSession, change: dict, part: str) -> None:
    """Put one staged partition in its place, unless that has been done."""
    staged, target = f"{change['staged']}/{part}", f"{change['table']}/{part}"
    if exists(spark, staged):
        remove_files(spark, [target])
        move(spark, staged, target)


def finish(spark: SparkSession, log: CommitLog, record: dict) -> None:
    """Apply a committed publication, or what is left of it."""
    for change in record["moves"]:
        table = change["table"]
        for name in change.get("files", []):
            if exists(spark, f"{change['staged']}/{name}"):
                move(spark, f"{change['staged']}/{name}", f"{table}/{change['name']}-{name}")
        for part in change.get("parts", []):
            move_part(spark, change, part)
        remove_files(spark, [f"{table}/{part}" for part in change.get("removed", [])])
        if exists(spark, table):
            spark.catalog.refreshByPath(table)
    remove_files(spark, [record["staging"]])
    log.add({"published": record["name"], **({"changes": record["then"]} if record["then"] else {})})


def unfinished(log: CommitLog, after: int = 0, known: Sequence[dict] = ()) -> list[dict]:
    """Publications committed but not done, among ``known`` ones and those of commits behind ``after``."""
    found = {r["name"]: r for r in known}
    for number in log.numbers(after):
        record = log.read(number)
        if "publish" in record:
            found[record["publish"]["name"]] = record["publish"]
        elif "published" in record:
            found.pop(record["published"], None)
    return list(found.values())


def recover(spark: SparkSession, log: CommitLog, staging: str, owner: str, after: int = 0, known: Sequence[dict] = ()) -> int:
    """Finish what the owner's earlier run had committed, and remove what it had staged without; returns how many publications
    were finished."""
    mine = [r for r in unfinished(log, after, known) if r["owner"] == owner]
    for record in mine:
        finish(spark, log, record)
    remove_files(spark, [f"{staging}/{owner}"])
    return len(mine)
