import math
import random

import numpy as np
from pyspark.sql import functions as F

from wattlake.llm import topk


def brute(rows, k=5, every=3):
    """Best k of each query; an id on several rows counts once, with its best score."""
    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and usable(v)]
    best = {}
    for q, a in whole:
        if q % every == 0:
            for c, b in whole:
                if c != q:
                    score = max(-2 ** 63, min(2 ** 63 - 1, sum(x * y for x, y in zip(a, b))))
                    best[q, c] = max(best.get((q, c), score), score)
    found = []
    for q in {q for q, _ in best}:
        hits = sorted(((c, s) for (p, c), s in best.items() if p == q), key=lambda x: (-x[1], x[0]))[:k]
        found += [(q, n, c, s) for n, (c, s) in enumerate(hits, 1)]
    return sorted(found)


def run(spark, rows, k=5, every=3):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).withColumn("rank", F.lit(2))
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % every == 0, k).collect())


def test_equals_brute_force_with_ties(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1.0, -0.25, 0.0, 0.5, 1.0]) for _ in range(6)]) for i in range(300)]
    assert run(spark, rows) == brute(rows)


def test_dense_vectors_over_many_shards(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(0, 0.15, 64).astype(np.float32).tolist()) for i in range(700)]
    monkeypatch.setattr(topk, "SHARD_ROWS", 50)
    assert run(spark, rows, every=50) == brute(rows, every=50)


def test_slices_of_queries(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(120)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    monkeypatch.setattr(topk, "SLICE_BYTES", 400)
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (3, None), (6, [None, 1.0]), (9, [float("nan"), 1.0]), (12, [float("inf")]), (15, []), (18, [0.5]),
            (None, [1.0]), (21, [1.0, 2.0]), (21, [1.0, 2.0]), (21, [-1.0, 0.0]), (22, [3.0, 0.0, 1.0]), (-3, [0.25, 0.25])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == [] and run(spark, [(0, [1.0])]) == [] and run(spark, [(1, [1.0]), (2, [1.0])]) == []


def test_common_vector(spark):
    rows = [(i, [0.5, 0.5]) for i in range(400)] + [(1000, [1.0, -1.0])]
    got = run(spark, rows, every=100)
    assert got == brute(rows, every=100)


def test_large_components_stay_exact(spark):
    rows = [(0, [1e6, -3.0]), (1, [1e6, 1.0]), (2, [1e6, 2.0]), (3, [-1e9, 1e9]), (4, [1e9, 1.0])]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert run(spark, rows) == brute(rows)


def test_pruning_skips_rows():
    """A shard whose bounds are below the k-th score is not read further."""
    best = topk.Best(1, 1)
    best.add(0, [100.0], [7])
    topk.scan_shard(np.array([[1.0, 1.0]]), np.array([0]), np.array([[3.0, 4.0]]), np.array([9]), best)
    assert best.rows == [[(100.0, 7)]]
    topk.scan_shard(np.array([[1.0, 1.0]]), np.array([0]), np.array([[60.0, 40.0]]), np.array([3]), best)
    assert best.rows == [[(100.0, 3)]]  # a tie goes to the smaller id


def test_nothing_is_crossed(spark, sf_dir):
    from wattlake.llm import queries
    plan = queries.op5_exact_top_k(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
