import hashlib
from collections import Counter

import pytest
from helpers import ODD, docs

from wattlake.llm import queries, sharding

NAMES = [f"s{i}" for i in range(7)]


def brute_table(names, size):
    """Whole preference lists, and turns over them."""
    h = lambda purpose, n: int(hashlib.sha256(f"{purpose}:{n}".encode()).hexdigest()[:16], 16)
    wishes = []
    for n in names:
        start, step = h("start", n) % size, h("step", n) % (size - 1) + 1
        wishes.append([(start + j * step) % size for j in range(size)])
    table = {}
    while len(table) < size:
        for i, wish in enumerate(wishes):
            if len(table) < size:
                table[next(s for s in wish if s not in table)] = i
    return [table[s] for s in range(size)]


def test_table_equals_brute_force():
    assert sharding.lookup_table(NAMES, 211) == brute_table(NAMES, 211)
    assert sharding.lookup_table(["one"], 13) == [0] * 13


def test_shards_hold_alike_and_few_slots_move():
    before = sharding.lookup_table(NAMES, 65537)
    counts = Counter(before).values()
    assert max(counts) - min(counts) <= 1
    after = sharding.lookup_table(NAMES[:-1], 65537)
    moved = sum(a != b for a, b in zip(after, before) if b != 6)
    assert moved / 65537 < 0.15


@pytest.mark.parametrize("names, size", [([], 13), (["a", "a"], 13), (NAMES, 7), (NAMES, 15)])
def test_refuses(names, size):
    with pytest.raises(ValueError):
        sharding.lookup_table(names, size)


def test_odd_rows_and_clashing_columns(spark):
    df = docs(spark, ODD).withColumnRenamed("fp", "slot").withColumnRenamed("start", "shard")
    got = sharding.place(df, ["doc_id"], NAMES, 211)
    rows = got.collect()
    table = sharding.lookup_table(NAMES, 211)
    assert len(rows) == len(ODD) and got.columns[-2:] == ["slot", "shard"]
    assert all(r.shard == NAMES[table[r.slot]] for r in rows)
    assert len({r.shard for r in rows if r.doc_id is None}) == 1
    assert sharding.place(docs(spark, []), ["doc_id"], NAMES, 211).count() == 0


def test_one_narrow_pass(spark, sf_dir):
    df = queries.op4_sharding(spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hash" not in plan and "BroadcastHashJoin" in plan and "ReadSchema: struct<doc_id:bigint>" in plan
    assert df.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
