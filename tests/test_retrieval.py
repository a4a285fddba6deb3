"""Vectors and retrieval against brute force."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlake.operators import retrieval


def vectors(spark, matrix, name):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{name} long, embedding array<double>")


def brute_force(queries, items, k):
    def unit(m):
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, n, out=np.zeros_like(m), where=n > 0)

    scores = np.round(unit(queries) @ unit(items).T, 9)
    return {
        (q, r + 1): (int(i), round(float(scores[q, i]), 6))
        for q in range(len(queries))
        for r, i in enumerate(sorted(range(len(items)), key=lambda i: (-scores[q, i], i))[:k])
    }


def result(df):
    return {(r.query_id, r["rank"]): (r.item_id, round(r.score, 6)) for r in df.collect()}


@pytest.fixture(scope="module")
def matrices():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    items = np.concatenate([c + 0.2 * rng.normal(size=(40, 8)) for c in centres])
    items[5] = items[7]          # exact ties
    items[100:140] = items[100]  # many copies of one item
    items[11] = 0
    return centres[:4] + 0.1, items


def test_broadcast_and_block_search_are_exact(spark, matrices):
    queries, items = matrices
    q, i = vectors(spark, queries, "query_id"), vectors(spark, items, "item_id").repartition(5)
    want = brute_force(queries, items, 5)
    assert result(retrieval.top_k(q, i, 5)) == want
    for most in (0, 64, 200):
        assert result(retrieval.top_k(q, i, 5, max_broadcast_bytes=most)) == want
    sliced = retrieval.top_k(q, i, 5, max_broadcast_bytes=64)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in sliced and "CoGroup" not in sliced and sliced.count("MapInPandas") == 4  # no item is moved
    assert len(result(retrieval.top_k(q, i, 500))) == 4 * len(items)
    assert result(retrieval.top_k(q.limit(0), i, 5)) == {}
    assert result(retrieval.top_k(q, i.limit(0), 5)) == {}


def test_cells_are_exact_and_skip_items(spark, matrices):
    queries, items = matrices
    q, i = vectors(spark, queries, "query_id"), vectors(spark, items, "item_id")
    for n in (1, 6, 20):
        centres = retrieval.pick_centres(i, n)
        stored = retrieval.assign_cells(i, centres)
        assert result(retrieval.top_k_in_cells(q, stored, centres, 5)) == brute_force(queries, items, 5)
    # a query asking for more than its nearest cell holds
    assert result(retrieval.top_k_in_cells(q, stored, centres, 150)) == brute_force(queries, items, 150)


def rows_read(spark, df):
    """Rows that the scans of a plan gave, once it has run."""
    found = []

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "FileSourceScanExec":
            found.append(int(node.metrics().apply("numOutputRows").value()))
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        if kind == "InMemoryTableScanExec":
            return walk(node.relation().cachedPlan())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(found)


def test_stored_cells_are_exact_and_read_less(spark, matrices, tmp_path):
    queries, items = matrices
    q = vectors(spark, queries, "query_id")
    retrieval.write_cells(vectors(spark, items, "item_id").repartition(3), str(tmp_path / "index"), 12)
    stored, centres = retrieval.read_cells(spark, str(tmp_path / "index"))
    assert centres.agg(F.sum("n")).first()[0] == len(items)
    for most in (1, 200, 1 << 20):  # one slice, or a slice for each query
        assert result(retrieval.top_k_in_cells(q, stored, centres, 5, most)) == brute_force(queries, items, 5)
    assert result(retrieval.top_k_in_cells(q, stored, centres, 150)) == brute_force(queries, items, 150)
    one = q.where("query_id = 0")
    hits = retrieval.top_k_in_cells(one, stored, centres, 5)
    hits.collect()
    plain = retrieval.top_k(one, stored.select("item_id", "embedding"), 5)
    plain.collect()
    assert rows_read(spark, plain) == len(items)
    assert 0 < rows_read(spark, hits) < len(items) / 2
    assert result(retrieval.top_k_in_cells(q.limit(0), stored, centres, 5)) == {}


def test_hashed_embedding(spark):
    texts = ["Wind and wind", "", None, "été_été 12"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r.id: np.array(r.embedding) for r in retrieval.embed(df).collect()}
    for i, text in enumerate(texts):
        want = np.zeros(256)
        for w in re.findall(r"[^\W_]+", (text or "").lower()):
            want[int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 256] += 1
        want = want / np.linalg.norm(want) if want.any() else want
        assert np.allclose(got[i], want)


def test_embedding_takes_any_model(spark):
    df = spark.createDataFrame([("ab",), ("abc",)], "text string")
    made = retrieval.embed(df, model=lambda texts: [np.array([len(t), 1.0]) for t in texts])
    assert {tuple(r.embedding) for r in made.collect()} == {(2.0, 1.0), (3.0, 1.0)}


def test_rerank_context_evaluation_and_trace(spark):
    hits = spark.createDataFrame(
        [(1, "a", 0.9, 1, "solar power price", "wind only"), (1, "b", 0.8, 2, "solar power price", "solar POWER!"),
         (1, "c", 0.7, 3, "solar power price", "price of solar power"), (1, "d", 0.6, 4, "solar power price", "x"),
         (2, "a", 0.5, 1, "hydro", "wind only")],
        "query_id long, item_id string, score double, rank int, query_text string, text string")
    best = retrieval.rerank(hits, 2).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.item_id, r.overlap) for r in best] == [(1, "c", 1.0), (1, "b", 0.666667), (2, "a", 0.0)]
    context = {r.query_id: r for r in retrieval.assemble_context(hits.where("rank <= 2")).collect()}
    assert context[1].context == "wind only\n\nsolar POWER!" and context[1].citations == "a,b"
    queries = spark.createDataFrame([(1,), (2,), (3,)], "query_id long")
    row = retrieval.evaluate(hits, F.col("item_id") == "b", queries).first()
    assert (row.k, row.n_queries, round(row.hit_rate, 6), round(row.mrr, 6)) == (5, 3, 0.333333, 0.166667)
    by_k = {r.k: r.mrr for r in retrieval.evaluate(hits, F.col("item_id") == "c", queries, [1, 3]).collect()}
    assert by_k[1] == 0 and round(by_k[3], 6) == 0.111111
    assert retrieval.trace(hits, "r1").where("run_id = 'r1' AND retrieved_at IS NOT NULL").count() == 5
