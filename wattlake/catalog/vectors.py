"""Embedding and retrieval: label centres against ``embeddings``, benchmark items against document chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.catalog import fixtures as fx
from wattlake.catalog.registry import query
from wattlake.operators import chunks, retrieval
from wattlake.session import scratch_path

# ---------------------------------------------------------------- ready vectors


def _items(spark, sf_dir):
    return fx.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("item_id"), "embedding", "label")


def _centres(items):
    """The mean vector of each label, as queries. Every component is averaged on its own, so that no
    label's vectors are gathered in one place."""
    means = items.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(
        F.round(F.avg(F.col("x").cast("double")), 9).alias("x"))
    return means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v")).select(
        F.col("label").cast("bigint").alias("query_id"), F.transform("v", lambda e: e["x"]).alias("embedding"))


_CENTRES_SQL = """means AS (SELECT label, i, round(avg(embedding[i]::DOUBLE), 9) AS x
  FROM (SELECT label, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings) GROUP BY 1, 2),
centres AS (SELECT label::BIGINT AS query_id, list(x ORDER BY i) AS embedding FROM means GROUP BY 1)"""


def _ranked_sql(items: str = "embeddings", k: int = 5) -> str:
    return f"""scored AS (SELECT query_id, vec_id AS item_id, label,
    round(list_cosine_similarity(c.embedding, e.embedding::DOUBLE[]), 9) AS score FROM centres c CROSS JOIN {items} e),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id)::INTEGER AS rank
  FROM scored QUALIFY rank <= {k})"""


def _hits(spark, sf_dir, k=retrieval.K):
    items = _items(spark, sf_dir)
    centres = _centres(items)
    return retrieval.attach_items(
        retrieval.top_k(centres, items, k), items.select("item_id", "label"), k * centres.count())


_HITS_SQL = "SELECT query_id, item_id, round(score, 6) AS score, rank FROM ranked"


@query(f"WITH {_CENTRES_SQL}, {_ranked_sql()} {_HITS_SQL}")
def topk_cosine(spark, sf_dir):
    """The five vectors nearest to the centre of each label."""
    items = _items(spark, sf_dir)
    return retrieval.top_k(_centres(items), items)


@query(f"WITH {_CENTRES_SQL}, {_ranked_sql()} {_HITS_SQL}")
def topk_blocks(spark, sf_dir):
    """The same when the queries are too many to be sent to every task: in slices, here of four, over items left in place."""
    items = _items(spark, sf_dir)
    return retrieval.top_k(_centres(items), items, max_broadcast_bytes=4 * 64 * 8)


@query(f"WITH {_CENTRES_SQL}, {_ranked_sql()} {_HITS_SQL}")
def topk_cells(spark, sf_dir):
    """The same through a stored coarse index that rules out cells which cannot hold a better hit."""
    path = scratch_path(spark, "cells")
    retrieval.write_cells(_items(spark, sf_dir).drop("label"), path, 16)
    return retrieval.top_k_in_cells(_centres(_items(spark, sf_dir)), *retrieval.read_cells(spark, path))


@query(f"""WITH {_CENTRES_SQL}, {_ranked_sql('(SELECT * FROM embeddings WHERE label IN (1, 3, 5, 7, 9)) ')} {_HITS_SQL}""")
def topk_filtered(spark, sf_dir):
    """The nearest vectors among those with one of some labels."""
    items = _items(spark, sf_dir)
    return retrieval.top_k(_centres(items), items.where(F.col("label").isin(1, 3, 5, 7, 9)))


@query(f"""WITH {_CENTRES_SQL}, {_ranked_sql(k=20)}, first_hit AS (
  SELECT query_id, min(rank) AS r FROM ranked WHERE label = query_id GROUP BY 1)
SELECT k, count(*) AS n_queries, round(avg(CASE WHEN r <= k THEN 1.0 ELSE 0.0 END), 6) AS hit_rate,
  round(avg(CASE WHEN r <= k THEN 1.0 / r ELSE 0.0 END), 6) AS mrr
FROM centres LEFT JOIN first_hit USING (query_id), (VALUES (1), (3), (5), (20)) AS c(k) GROUP BY 1""")
def retrieval_hit_rate(spark, sf_dir):
    """Hit rate and mean reciprocal rank at several cut-offs, a hit being a vector of the query's own label."""
    return retrieval.evaluate(
        _hits(spark, sf_dir, 20), F.col("label") == F.col("query_id"), _centres(_items(spark, sf_dir)), [1, 3, 5, 20])


@query(f"WITH {_CENTRES_SQL}, {_ranked_sql()} SELECT 'run-1' AS run_id, query_id, rank, item_id, round(score, 6) AS score FROM ranked")
def retrieval_trace(spark, sf_dir):
    """Log rows of a retrieval run, without their time."""
    return retrieval.trace(_hits(spark, sf_dir), "run-1").drop("retrieved_at")


# ---------------------------------------------------------------- texts

_BUCKETS_SQL = """SELECT {id}, ('0x' || substr(md5(w), 1, 8))::BIGINT % 256 AS bucket, count(*)::DOUBLE AS n FROM (
  SELECT {id}, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS w FROM {rows}) GROUP BY ALL"""


def _unit_sql(name: str, id: str, rows: str) -> str:
    return f"""{name}_n AS ({_BUCKETS_SQL.format(id=id, rows=rows)}),
{name} AS (SELECT {id}, bucket, n / sqrt(sum(n * n) OVER (PARTITION BY {id})) AS weight FROM {name}_n)"""


@query(f"""WITH {_unit_sql('v', 'doc_id', 'documents')}
SELECT doc_id, bucket::INTEGER AS bucket, round(weight, 6) AS weight FROM v""")
def embed_hashed(spark, sf_dir):
    """Hashed word vectors of whole documents, as their non-zero components."""
    vectors = retrieval.embed(fx.documents(spark, sf_dir).select("doc_id", "text"))
    return vectors.select("doc_id", F.posexplode("embedding").alias("bucket", "weight")).where("weight <> 0")


def _passages(docs):
    """Chunks as items."""
    return chunks.chunk_fixed(docs.select("doc_id", "text")).withColumn("item_id", F.concat_ws("-", "doc_id", "pos"))


def _questions(spark, sf_dir):
    return fx.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))


def _passages_sql(condition: str = "true") -> str:
    return f"""passage AS (SELECT doc_id || '-' || i AS item_id, substr(text, 1 + i * 800, 1000) AS text FROM (
    SELECT doc_id, text, unnest(generate_series(0, greatest(ceil((length(text) - 200) / 800.0), 1)::BIGINT - 1)) AS i
    FROM documents WHERE {condition})),
question AS (SELECT item_id AS query_id, text FROM benchmark),
{_unit_sql('p', 'item_id', 'passage')}, {_unit_sql('q', 'query_id', 'question')},
dots AS (SELECT query_id, item_id, round(sum(p.weight * q.weight), 9) AS score FROM q JOIN p USING (bucket) GROUP BY 1, 2),
hits AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id)::INTEGER AS rank
  FROM dots QUALIFY rank <= 5)"""


_PASSAGES_SQL = _passages_sql()


def _passage_hits(spark, sf_dir, docs=None):
    """Five passages per question with both texts."""
    passages = _passages(fx.documents(spark, sf_dir) if docs is None else docs)
    questions = _questions(spark, sf_dir)
    hits = retrieval.top_k(
        retrieval.embed(questions, "query_text"), retrieval.embed(passages.select("item_id", "text")))
    found = retrieval.attach_items(hits, passages.select("item_id", "text"), retrieval.K * questions.count())
    return found.join(questions, "query_id")


@query(f"WITH {_PASSAGES_SQL} SELECT query_id, item_id, round(score, 6) AS score, rank FROM hits")
def retrieve_passages(spark, sf_dir):
    """The document passages most similar to each benchmark item."""
    return _passage_hits(spark, sf_dir).select("query_id", "item_id", "score", "rank")


_GOOD = "lang = 'en' AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)"


@query(f"WITH {_passages_sql(_GOOD)} SELECT query_id, item_id, round(score, 6) AS score, rank FROM hits")
def retrieve_filtered(spark, sf_dir):
    """The same among English documents of good quality only: metadata is filtered before the search."""
    good = fx.table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    docs = fx.documents(spark, sf_dir).where("lang = 'en'").join(good, "doc_id", "left_semi")
    return _passage_hits(spark, sf_dir, docs).select("query_id", "item_id", "score", "rank")


_WORDS = "list_distinct(regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}]+'))"


@query(f"""WITH {_PASSAGES_SQL}, o AS (SELECT query_id, item_id, score, {_WORDS.format('question.text')} AS a,
    {_WORDS.format('passage.text')} AS b FROM hits JOIN question USING (query_id) JOIN passage USING (item_id)),
s AS (SELECT query_id, item_id, score, round(len(list_intersect(a, b)) / greatest(len(a), 1), 6) AS overlap FROM o)
SELECT query_id, item_id, round(score, 6) AS score, overlap,
  row_number() OVER (PARTITION BY query_id ORDER BY overlap DESC, s.score DESC, item_id)::INTEGER AS rank
FROM s QUALIFY rank <= 3""")
def rerank_top3(spark, sf_dir):
    """The best three of five passages by shared words."""
    return retrieval.rerank(_passage_hits(spark, sf_dir)).select("query_id", "item_id", "score", "overlap", "rank")


@query(f"""WITH {_PASSAGES_SQL}
SELECT query_id, string_agg(passage.text, chr(10) || chr(10) ORDER BY rank) AS context,
  string_agg(item_id, ',' ORDER BY rank) AS citations FROM hits JOIN passage USING (item_id) GROUP BY 1""")
def retrieval_context(spark, sf_dir):
    """The retrieved passages of each question as one text with citations."""
    return retrieval.assemble_context(_passage_hits(spark, sf_dir))
