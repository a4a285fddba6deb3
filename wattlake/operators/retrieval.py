"""Vectors: hashed embedding, exact nearest neighbours, reranking, context and evaluation.

Nearest neighbours are searched block by block: every task multiplies a batch of stored vectors
with the query vectors and passes on its best ``k`` per query only, so the shuffle carries
``k * queries`` rows per task and never a row per pair. Queries beyond a size go in slices, each of which
passes over the items once; items are never copied or moved.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.functions.memory import give_back

DIMENSIONS = 256
K, RERANKED = 5, 3
# Queries of this size go to every task at once; more go in slices.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
QUERIES_PER_SLICE = 512  # of a score matrix
# Hits up to this number are sent to the items instead of shuffling the items to the hits.
MAX_BROADCAST_HITS = 1_000_000
_SCORE_DIGITS = 9  # scores are rounded before ranking, so that equal vectors tie exactly

_WORD = re.compile(r"[^\W_]+")
# Bounds of what a worker holds at a time, whatever the size of Spark's batches.
_CACHED_WORDS, _CACHED_LENGTH = 1 << 16, 64
_CHARS_AT_ONCE = 1 << 20
ROWS_AT_ONCE = 512  # texts that are embedded, or items that meet a slice of queries


# ---------------------------------------------------------------- embedding

class _Buckets(dict):
    """The buckets of words met before. It starts anew when full, and long words are not kept, so its size is bounded."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions

    def __missing__(self, word: bytes) -> int:
        found = int.from_bytes(hashlib.md5(word).digest()[:4], "big") % self.dimensions
        if len(word) <= _CACHED_LENGTH:
            if len(self) >= _CACHED_WORDS:
                self.clear()
            self[word] = found
        return found


_buckets: dict[int, _Buckets] = {}  # of this worker


_in_word: np.ndarray | None = None


def _word_characters() -> np.ndarray:
    """Whether each code point is part of a word; made once in a process."""
    global _in_word
    if _in_word is None:
        _in_word = np.array([_WORD.match(chr(i)) is not None for i in range(0x110000)])
    return _in_word


def hashed_vectors(texts: pd.Series, dimensions: int = DIMENSIONS) -> list[np.ndarray]:
    """Word counts by hash bucket, scaled to unit length. Needs no model and no vocabulary."""
    vectors, some, size = [], [], 0
    for text in texts:
        text = (text or "").lower()
        if some and (size + len(text) > _CHARS_AT_ONCE or len(some) >= ROWS_AT_ONCE):
            vectors += _hashed(some, dimensions)
            some, size = [], 0
        some.append(text)
        size += len(text)
    return vectors + _hashed(some, dimensions)


def _utf8_size(codes: np.ndarray) -> np.ndarray:
    """How many bytes each code point takes."""
    return 1 + (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000)


def _hashed(texts: list[str], dimensions: int) -> list[np.ndarray]:
    """The words of some texts are found in their characters at once, and each different one is hashed once."""
    joined = "\n".join([*texts, ""])
    data = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
    codes = data if joined.isascii() else np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    inside = _word_characters()[codes]
    letters = data[inside if codes is data else np.repeat(inside, _utf8_size(codes))]
    turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        turns = np.concatenate([[0], turns])
    first, past = turns[::2], turns[1::2]  # the last character is a line end
    if codes is data:
        places = np.cumsum(past - first)
    else:
        sizes = np.cumsum(np.where(inside, _utf8_size(codes), 0))
        places = sizes[past - 1]
    places = np.concatenate([[0], places]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(places), pa.py_buffer(letters)])
    words = words.dictionary_encode()
    buckets = _buckets.setdefault(dimensions, _Buckets(dimensions))
    different = words.dictionary.to_numpy(zero_copy_only=False)
    found = np.fromiter(map(buckets.__getitem__, different), np.int64, len(different))
    ends = np.cumsum([len(t) + 1 for t in texts])
    owner = np.searchsorted(ends, first, side="right")
    counts = np.bincount(owner * dimensions + found[words.indices.to_numpy(zero_copy_only=False)], minlength=len(texts) * dimensions)
    counts = counts.reshape(len(texts), dimensions)
    norms = np.sqrt((counts * counts).sum(axis=1, keepdims=True).astype(np.float64))
    return list(np.divide(counts, norms, out=np.zeros(counts.shape), where=norms > 0))


def embed(df: DataFrame, text: str = "text", output: str = "embedding",
          model: Callable[[pd.Series], list[np.ndarray]] = hashed_vectors) -> DataFrame:
    """Adds the embedding of a text column; ``model`` turns a series of texts into vectors, of some rows at a time."""
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            for at in range(0, len(texts), ROWS_AT_ONCE):
                some = texts.iloc[at:at + ROWS_AT_ONCE]
                yield pd.Series(model(some), index=some.index, dtype=object)
        give_back()

    # Marked so that the optimizer does not evaluate it a second time for a filter on its result.
    return df.withColumn(output, vectors.asNondeterministic()(text))


# ---------------------------------------------------------------- nearest neighbours

_PARTIAL = "query_id {q}, item_id {i}, score double"


def _unit_rows(vectors: pd.Series) -> np.ndarray:
    matrix = np.stack(vectors.to_numpy()).astype(np.float64)
    norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


_BEST_FIRST = {"by": ["query_id", "score", "item_id"], "ascending": [True, False, True]}


def _first_k(found: pd.DataFrame, k: int) -> pd.DataFrame:
    return found.sort_values(**_BEST_FIRST).groupby("query_id", sort=False).head(k)


def _best(query_ids: np.ndarray, query_matrix: np.ndarray, item_ids: np.ndarray, item_matrix: np.ndarray,
          k: int) -> pd.DataFrame:
    """The ``k`` best items of each query within one block, ties by the lower id.

    Exactly ``k`` are picked even if the block is full of copies of one item: those above the k-th
    score, then as many of those with that score as are missing, in the order of their ids. Queries
    go in slices to bound the score matrix.
    """
    by_id = np.argsort(item_ids, kind="stable")
    item_ids, item_matrix = item_ids[by_id], item_matrix[by_id]
    found = []
    for i in range(0, len(query_ids), QUERIES_PER_SLICE):
        ids = query_ids[i:i + QUERIES_PER_SLICE]
        scores = np.round(query_matrix[i:i + QUERIES_PER_SLICE] @ item_matrix.T, _SCORE_DIGITS)
        picked = np.ones(scores.shape, dtype=bool)
        if scores.shape[1] > k:
            kth = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k][:, None]
            above, level = scores > kth, scores == kth
            missing = k - above.sum(axis=1, keepdims=True)
            picked = above | (level & (np.cumsum(level, axis=1) <= missing))
        rows, cols = np.nonzero(picked)
        found.append(pd.DataFrame({"query_id": ids[rows], "item_id": item_ids[cols], "score": scores[rows, cols]}))
    return pd.concat(found)


def _search_batches(query_ids: np.ndarray, query_matrix: np.ndarray, k: int,
                    queries_of_cell: dict[int, np.ndarray] | None = None):
    """Search over the batches of one task. With cells, an item meets only the queries of its cell."""
    def scored(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        matrix, ids = _unit_rows(batch["embedding"]), batch["item_id"].to_numpy()
        if queries_of_cell is None:
            yield _best(query_ids, query_matrix, ids, matrix, k)
            return
        cells = batch["cell"].to_numpy()
        for cell in np.unique(cells):
            chosen = queries_of_cell.get(int(cell))
            if chosen is not None and len(chosen):
                here = cells == cell
                yield _best(query_ids[chosen], query_matrix[chosen], ids[here], matrix[here], k)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for batch in batches:
            for at in range(0, len(batch), ROWS_AT_ONCE):
                for found in scored(batch.iloc[at:at + ROWS_AT_ONCE]):
                    kept = _first_k(found if kept is None else pd.concat([kept, found]), k)
        if kept is not None:
            yield kept
        give_back()
    return search


def _slices(queries: DataFrame, max_bytes: int, per_query: int = 0) -> Iterator[pd.DataFrame]:
    """``query_id, embedding`` of all queries in local frames of about ``max_bytes``, dealt by the hash of their ids;
    ``per_query`` are bytes that each needs besides its vector."""
    size = queries.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("embedding")), F.lit(0)).alias("numbers")).first()
    slices = max(1, -(-(size.numbers * 8 + size.n * per_query) // max(1, max_bytes)))
    slices = min(slices, max(1, size.n))
    for i in range(slices):
        local = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(slices)) == i).toPandas() if slices > 1 else queries.toPandas()
        if len(local):
            yield local


def rank_within(df: DataFrame, by: str, *order: Column, k: int | None = None) -> DataFrame:
    """Adds ``rank`` within ``by``; with ``k`` only the first k are kept, on both sides of the shuffle."""
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order)))
    return ranked if k is None else ranked.where(F.col("rank") <= k)


def top_k(queries: DataFrame, items: DataFrame, k: int = K, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """The ``k`` items most similar to each query by cosine, ties by item id. Exact.

    ``queries`` has ``query_id, embedding``; ``items`` has ``item_id, embedding``. Columns of the
    result: ``query_id, item_id, score, rank``. Filter ``items`` first to search part of them.
    """
    queries = queries.select("query_id", "embedding")
    items = items.select("item_id", "embedding")
    schema = _PARTIAL.format(q=dict(queries.dtypes)["query_id"], i=dict(items.dtypes)["item_id"])
    found = [items.mapInPandas(_search_batches(local["query_id"].to_numpy(), _unit_rows(local["embedding"]), k), schema)
             for local in _slices(queries, max_broadcast_bytes)]
    return _ranked_hits(found, items.sparkSession, schema, k)


def _ranked_hits(found: list[DataFrame], spark, schema: str, k: int) -> DataFrame:
    """The best of the hits of several passes."""
    partial = reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)
    return rank_within(partial, "query_id", F.desc("score"), F.asc("item_id"), k=k)


# ---------------------------------------------------------------- coarse cells

def pick_centres(items: DataFrame, n: int) -> DataFrame:
    """``n`` items, chosen by the hash of their id, to serve as cell centres (``cell, embedding``)."""
    chosen = items.select(F.xxhash64("item_id").alias("cell"), "embedding").orderBy("cell").limit(n)
    return chosen.withColumn("cell", F.row_number().over(Window.orderBy("cell")).cast("long"))


def assign_cells(items: DataFrame, centres: DataFrame) -> DataFrame:
    """Adds ``cell``, the nearest centre, and ``angle``, the angle to it."""
    local = centres.select("cell", "embedding").orderBy("cell").toPandas()
    ids, matrix = local["cell"].to_numpy(), _unit_rows(local["embedding"])

    @F.pandas_udf("cell long, angle double")
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        scores = _unit_rows(vectors) @ matrix.T
        best = scores.argmax(axis=1)
        return pd.DataFrame({"cell": ids[best], "angle": np.arccos(np.clip(scores.max(axis=1), -1, 1))})

    near = items.withColumn("__near", nearest.asNondeterministic()("embedding"))
    return near.select(*items.columns, "__near.cell", "__near.angle")


def write_cells(items: DataFrame, path: str, n_cells: int) -> None:
    """Store items as an inverted file: a folder for each of ``n_cells`` cells, dealt over many files where a cell is large,
    with its items in the order of their angles; beside it the centres, each with its cell's size and widest angle."""
    spark = items.sparkSession
    centres = pick_centres(items, n_cells)
    assigned = assign_cells(items, centres).hint("rebalance", "cell")
    assigned.sortWithinPartitions("cell", "angle").write.partitionBy("cell").parquet(f"{path}/items")
    sizes = _cell_sizes(spark.read.parquet(f"{path}/items"))
    centres.join(sizes, "cell").write.parquet(f"{path}/centres")


def read_cells(spark, path: str) -> tuple[DataFrame, DataFrame]:
    """(items, centres) of a stored index."""
    items = spark.read.parquet(f"{path}/items").withColumn("cell", F.col("cell").cast("long"))
    return items, spark.read.parquet(f"{path}/centres")


def _cell_sizes(items: DataFrame) -> DataFrame:
    return items.groupBy(F.col("cell").cast("long").alias("cell")).agg(F.max("angle").alias("widest"), F.count(F.lit(1)).alias("n"))


def top_k_in_cells(queries: DataFrame, items: DataFrame, centres: DataFrame, k: int = K,
                   max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``top_k`` over items with cells, with the same exact result, by folders where the cells are folders.

    A first pass over each query's nearest cells, as many as hold ``k`` items, gives a score its k-th hit must reach. No item
    of a cell can come closer than the angle to the centre minus the cell's widest angle, nor, by its own angle, than the
    difference of the two; so a second pass opens only cells that may still hold a better one, and there skips the
    items whose angles rule them out. Queries go in slices, so that neither they nor their angles to all centres outgrow the
    driver. ``centres`` are few by their parameter; without ``widest`` and ``n`` these are counted first.
    """
    if "widest" not in centres.columns:
        centres = centres.join(_cell_sizes(items), "cell")
    cells = centres.select("cell", "embedding", "widest", "n").orderBy("cell").toPandas()
    schema = _PARTIAL.format(q=dict(queries.dtypes)["query_id"], i=dict(items.dtypes)["item_id"])
    items, found = items.select("item_id", "embedding", "cell", "angle"), []
    if len(cells):
        for local in _slices(queries.select("query_id", "embedding"), max_broadcast_bytes, per_query=16 * len(cells)):
            found += _search_cells(local, items, cells, k, schema)
    return _ranked_hits(found, items.sparkSession, schema, k)


def _search_cells(local: pd.DataFrame, items: DataFrame, cells: pd.DataFrame, k: int, schema: str) -> list[DataFrame]:
    """The hits of one slice of queries, in two passes over different cells."""
    query_ids, query_matrix = local["query_id"].to_numpy(), _unit_rows(local["embedding"])
    cell_ids, radius = cells["cell"].to_numpy(), cells["widest"].to_numpy()
    angles = np.arccos(np.clip(query_matrix @ _unit_rows(cells["embedding"]).T, -1, 1))

    def search(may_hold: np.ndarray, reach: np.ndarray) -> DataFrame:
        """Hits among the items of cells that ``may_hold`` (queries x cells) allows, within an angle ``reach`` of a query."""
        by_cell = {int(c): np.nonzero(may_hold[:, j])[0] for j, c in enumerate(cell_ids)}
        wanted = [c for c, q in by_cell.items() if len(q)]
        rows = items.where(F.col("cell").isin(wanted))
        rings = [(c, float((angles[q, j] - reach[q]).min()), float((angles[q, j] + reach[q]).max()))
                 for j, (c, q) in enumerate(by_cell.items()) if len(q)]
        lowest, highest = min((r[1] for r in rings), default=0.0), max((r[2] for r in rings), default=0.0)
        rows = rows.where((F.col("angle") >= lowest) & (F.col("angle") <= highest))  # read from the files' statistics
        return rows.select("item_id", "embedding", "cell").mapInPandas(_search_batches(query_ids, query_matrix, k, by_cell), schema)

    order = np.argsort(angles, axis=1, kind="stable")
    before = np.cumsum(cells["n"].to_numpy()[order], axis=1) - cells["n"].to_numpy()[order]
    nearest = np.zeros(angles.shape, bool)
    np.put_along_axis(nearest, order, before < k, axis=1)
    everywhere = np.full(len(query_ids), np.pi + 1)
    first = search(nearest, everywhere)
    ranked = rank_within(first, "query_id", F.desc("score"), F.asc("item_id"), k=k).persist()
    reached = ranked.where(F.col("rank") == k).select("query_id", "score").toPandas()
    reached = dict(zip(reached["query_id"], reached["score"], strict=True))
    must_reach = np.array([reached.get(q, -1.0) for q in query_ids])
    best_possible = np.cos(np.clip(angles - radius[None, :], 0, np.pi))
    left = ~nearest & (best_possible >= must_reach[:, None] - 1e-6)
    hits = [ranked.drop("rank")]
    return hits + [search(left, np.arccos(np.clip(must_reach - 1e-6, -1, 1)))] if left.any() else hits


# ---------------------------------------------------------------- after retrieval

def word_set(text: Column) -> Column:
    """Distinct lower-case words of a text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), 1))


def attach_items(hits: DataFrame, items: DataFrame, max_hits: int) -> DataFrame:
    """``hits`` with the other columns of their items.

    ``max_hits`` is ``k`` times the number of queries. While that is small the hits are broadcast and
    the items, of whatever size, stay where they are.
    """
    return items.join(F.broadcast(hits) if max_hits <= MAX_BROADCAST_HITS else hits, "item_id")


def rerank(hits: DataFrame, keep: int = RERANKED) -> DataFrame:
    """Best ``keep`` of the retrieved items by the share of query words they contain.

    ``hits`` has ``query_id, item_id, score, query_text, text``; ties fall back to score and id.
    """
    asked, found = word_set(F.col("query_text")), word_set(F.col("text"))
    overlap = F.size(F.array_intersect(asked, found)) / F.greatest(F.size(asked), F.lit(1))
    scored = hits.drop("rank").withColumn("overlap", F.round(overlap, 6))
    return rank_within(scored, "query_id", F.desc("overlap"), F.desc("score"), F.asc("item_id"), k=keep)


def assemble_context(hits: DataFrame, separator: str = "\n\n") -> DataFrame:
    """One row per query: retrieved texts in rank order, and the ids cited. At most k rows per group."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "item_id", "text")))
    return hits.groupBy("query_id").agg(ordered.alias("h")).select(
        "query_id",
        F.array_join(F.transform("h", lambda x: x["text"]), separator).alias("context"),
        F.array_join(F.transform("h", lambda x: x["item_id"].cast("string")), ",").alias("citations"),
    )


def evaluate(hits: DataFrame, is_hit: Column, queries: DataFrame, ks: Sequence[int] = (K,)) -> DataFrame:
    """Hit rate and mean reciprocal rank for each cut-off ``k``, over all queries, those without any hit included.

    ``hits`` must reach down to the largest cut-off.
    """
    first_hit = hits.where(is_hit).groupBy("query_id").agg(F.min("rank").alias("first_rank"))
    cut_offs = F.explode(F.array(*[F.lit(k) for k in ks])).alias("k")
    found = F.coalesce(F.col("first_rank") <= F.col("k"), F.lit(False))
    return (
        queries.select("query_id").join(first_hit, "query_id", "left").select("first_rank", cut_offs)
        .groupBy("k").agg(
            F.count(F.lit(1)).alias("n_queries"),
            F.avg(F.when(found, 1.0).otherwise(0.0)).alias("hit_rate"),
            F.avg(F.when(found, 1.0 / F.col("first_rank")).otherwise(0.0)).alias("mrr"),
        )
    )


def trace(hits: DataFrame, run_id: str) -> DataFrame:
    """Log rows of a retrieval run."""
    return hits.select(
        F.lit(run_id).alias("run_id"), "query_id", "rank", "item_id", "score",
        F.current_timestamp().alias("retrieved_at"),
    )
