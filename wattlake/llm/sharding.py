"""Sharding by a permutation-filled lookup table.

Every shard orders the slots of a table of prime size by a permutation of its own (a start and a step, both hashes of its name).
Shards take turns, and on its turn a shard claims the first free slot of its order, until the table is full. So shards
hold as many slots as each other, give or take one, and when a shard comes or goes few other slots change hands.

The table depends on the shards alone and has ``size`` entries; it is broadcast, and a row's shard is one lookup by
the hash of its key. Rows are not shuffled, so no key, however common, gathers rows in one task.

Defined cases: a null key is a key like any other. Every row is placed, and equal keys go to the same shard. Columns named as
the two that are added are replaced. At least one shard is needed, their names must differ, and ``size`` must be
a prime above their number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIZE = 65537


def _hash(name: str, purpose: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{purpose}:{name}".encode()).digest()[:8], "big")


def lookup_table(shards: Sequence[str], size: int = SIZE) -> list[int]:
    """The number of the shard that holds each slot."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards must be named, each once")
    if size <= len(shards) or any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError("size must be a prime above the number of shards")
    place = [_hash(s, "start") % size for s in shards]
    step = [_hash(s, "step") % (size - 1) + 1 for s in shards]
    owner = [-1] * size
    free = size
    while True:
        for shard in range(len(shards)):
            slot = place[shard]
            while owner[slot] >= 0:
                slot = (slot + step[shard]) % size
            owner[slot], place[shard] = shard, (slot + step[shard]) % size
            free -= 1
            if not free:
                return owner


def slots(spark: SparkSession, shards: Sequence[str], size: int = SIZE) -> DataFrame:
    """(slot, shard): the table as a frame of ``size`` rows."""
    owners = F.split(F.lit(",".join(map(str, lookup_table(shards, size)))), ",").cast("array<int>")
    names = F.array(*[F.lit(s) for s in shards])
    return (spark.range(1).select(F.posexplode(owners).alias("slot", "owner"))
            .select(F.col("slot").cast("bigint").alias("slot"), F.get(names, F.col("owner")).alias("shard")))


def place(df: DataFrame, key: Sequence[str], shards: Sequence[str], size: int = SIZE) -> DataFrame:
    """``df`` with ``slot`` and ``shard`` of the columns ``key``."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in ("slot", "shard")]
    rows = df.select(F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in key]), F.lit(size)).alias("slot"), F.struct(*kept).alias("row"))
    return rows.join(F.broadcast(slots(df.sparkSession, shards, size)), "slot").select("row.*", "slot", "shard")
