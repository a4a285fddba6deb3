"""Exact top-k inner products by MaxScore over shards of the candidates.

Components become integers, so scores are exact. A dimension is a query term, its postings are a shard's column, and
what a term can add to a score is bounded by the query's component times the column's highest (or lowest) value.

A shard is a block of rows of one task. For each query the terms with the smallest bounds, as many as
together cannot lift a row over the query's k-th best score so far, are non-essential. A row can only compete if an
essential term adds to its score, so rows come from the essential columns; what the non-essential ones could
still add is put on top, and rows that stay below the k-th score are dropped. The rest is probed column by column,
in falling order of bounds, and dropped as soon as it cannot compete. The k-th score grows from shard to shard. Tasks
pass on k rows per query, and these are merged.

Queries are the rows a condition names, held against all rows. They are sent to the tasks in slices of bounded size, one
pass over the candidates each, so nothing that is broadcast grows with the data.

Defined cases: vectors that are null, or hold null, NaN or an infinite component, take no part. A shorter vector is
filled up with zeros. A query meets every row but those with its own id. An id on several rows counts once, with its best
score, as query and as candidate. Null ids take no part. Ties go to the smaller id. A score outside the range
of a long is held at its end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import all_of, stored

SLICE_BYTES = 8 << 20
SHARD_ROWS = 4096
_LONG = (-(1 << 63), (1 << 63) - 1)


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return all_of([vector.isNotNull(), F.coalesce(F.forall(vector, finite), F.lit(False))])


def integer(vector: Column, factor: int = 256) -> Column:
    """floor(factor * x) of each component, as doubles that hold whole numbers."""
    return F.transform(vector, lambda x: _floor(x.cast("double") * factor))


def _floor(x: Column) -> Column:
    # floor() of a double gives a long, which a large component would overflow.
    return F.when(F.abs(x) < 2.0 ** 62, F.floor(x).cast("double")).otherwise(x)


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """Vectors of any lengths as rows, filled up with zeros."""
    lengths = np.diff(vectors.offsets.to_numpy())
    values = vectors.values.to_numpy(zero_copy_only=False)[vectors.offsets[0].as_py():vectors.offsets[-1].as_py()]
    width = int(lengths.max(initial=0))
    if (lengths == width).all():
        return values.reshape(len(lengths), width).astype(np.float64)
    rows = np.zeros((len(lengths), width))
    rows[np.arange(width) < lengths[:, None]] = values
    return rows


def _aligned(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))


class Best:
    """The k best (score, id) of each query so far, ids once each; best first."""

    def __init__(self, queries: int, k: int):
        self.k, self.rows = k, [[] for _ in range(queries)]

    def threshold(self, query: int) -> float:
        """A score below this cannot enter."""
        rows = self.rows[query]
        return rows[-1][0] if len(rows) == self.k else -np.inf

    def add(self, query: int, scores: list, ids: list) -> None:
        best: dict[int, float] = {i: s for s, i in self.rows[query]}
        for score, i in zip(scores, ids):
            if i not in best or score > best[i]:
                best[i] = score
        self.rows[query] = sorted(((s, i) for i, s in best.items()), key=lambda x: (-x[0], x[1]))[:self.k]


def scan_shard(queries: np.ndarray, query_ids: np.ndarray, shard: np.ndarray, ids: np.ndarray, best: Best) -> None:
    """Bring ``best`` up to date with one shard's rows, by MaxScore."""
    queries, shard = _aligned(queries, shard)
    reach = float(np.abs(queries).max(initial=0)) * float(np.abs(shard).max(initial=0)) * max(1, shard.shape[1])
    huge = reach >= 2.0 ** 53
    if huge:  # doubles would round: whole numbers of any size instead, held in the range of a long before they compete
        queries, shard = (np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (queries, shard))
    columns = np.ascontiguousarray(shard.T) if shard.dtype != object else shard.T
    if not columns.shape[0]:
        columns, queries = np.zeros((1, len(ids))), np.zeros((len(queries), 1))
    high, low = columns.max(axis=1), columns.min(axis=1)
    for q, vector in enumerate(queries):
        bounds = np.maximum(np.maximum(vector * high, vector * low), 0)
        order = np.argsort(bounds.astype(float), kind="stable")
        sums = np.cumsum(bounds[order])
        least = -np.inf if huge else best.threshold(q)
        inessential = int(np.searchsorted(sums.astype(float), least, side="left")) if least > 0 else 0
        if inessential == len(order) and sums[-1] < least:
            continue  # nothing in this shard can compete
        inessential = min(inessential, len(order) - 1)
        essential = order[inessential:]
        score = vector[essential] @ columns[essential]
        rest = sums[inessential - 1] if inessential else 0
        rows = np.flatnonzero(score + rest >= least)
        for start in range(inessential, 0, -8):  # falling bounds, some columns at a time
            probed = order[max(0, start - 8):start]
            score = score[rows] if len(score) != len(rows) else score
            score = score + vector[probed] @ columns[np.ix_(probed, rows)]
            rest = sums[start - 9] if start > 8 else 0
            kept = score + rest >= least
            rows, score = rows[kept], score[kept]
            if not len(rows):
                break
        if len(score) != len(rows):
            score = score[rows]
        if huge:
            score = np.array([max(_LONG[0], min(_LONG[1], s)) for s in score], object)
        own = ids[rows] != query_ids[q]
        rows, score = rows[own], score[own]
        if len(rows):
            some = _leading(score, ids[rows], best.k)
            best.add(q, score[some].tolist(), ids[rows[some]].tolist())


def _leading(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places that hold the k best ids; ids may repeat."""
    if len(score) <= 4 * k:
        return np.arange(len(score))
    order = np.lexsort((ids, -score)) if score.dtype != object else np.array(
        sorted(range(len(score)), key=lambda i: (-score[i], ids[i])))
    _, first = np.unique(ids[order], return_index=True)
    return order[np.sort(first)[:k]]


# ---------------------------------------------------------------- operator

def top_k(vectors: DataFrame, is_query: Column, k: int = 5, factor: int = 256, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for every row that ``is_query`` (over the id, as ``vec_id``) names."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), F.col(f"`{vector_col}`").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).select(
        "vec_id", integer(F.col("vector"), factor).alias("vector"))
    queries = stored(rows.where(is_query), "queries")
    size = queries.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("width")).head()
    slices = max(1, -(-size.n * 8 * (size.width + 1) // SLICE_BYTES))
    spark, found = vectors.sparkSession, None
    for i in range(slices):
        part = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(slices)) == i) if slices > 1 else queries
        table = part.distinct().orderBy("vec_id").toArrow()
        if not table.num_rows:
            continue
        ids = table.column(0).to_numpy()
        sent = spark.sparkContext.broadcast((ids, _matrix(table.column(1).combine_chunks())))
        hits = _merged(rows.mapInArrow(_scan(sent, k), "query_id bigint, vec_id bigint, score bigint"), k)
        if slices > 1:
            hits = stored(hits, "hits")
        found = hits if found is None else found.union(hits)
    if found is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    return found


def _scan(sent, k: int):
    def run(batches):
        query_ids, queries = sent.value
        best = Best(len(query_ids), k)
        for batch in batches:
            for start in range(0, batch.num_rows, SHARD_ROWS):
                part = batch.slice(start, SHARD_ROWS)
                shard = _matrix(part.column(1))
                scan_shard(queries, query_ids, shard, part.column(0).to_numpy(), best)
        rows = [(int(q), i, int(s)) for q, hits in zip(query_ids, best.rows) for s, i in hits]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(3)],
                                         ["query_id", "vec_id", "score"])
    return run


def _merged(hits: DataFrame, k: int) -> DataFrame:
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (hits.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
