"""Cleaning, chunking, intake and incremental indexing of ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.catalog import fixtures as fx
from wattlake.catalog.registry import query
from wattlake.operators import chunks, cleaning, index, retrieval
from wattlake.operators.vector_store import VectorStore
from wattlake.session import scratch_path
from wattlake.sources import tables
from wattlake.sources.documents import read_documents

MIN_DOCS, MIN_SHARE = 2, 0.005

_LINES_SQL = r"""lines AS (SELECT doc_id, i AS pos,
    trim(regexp_replace(string_split(text, chr(10))[i], '[ \t\r\f]+', ' ', 'g'), ' ') AS line
  FROM (SELECT doc_id, text, unnest(generate_series(1, len(string_split(text, chr(10))))) AS i FROM documents)),
boiler AS (SELECT line, count(DISTINCT doc_id) AS n_docs FROM lines WHERE line <> '' GROUP BY 1
  HAVING count(DISTINCT doc_id) >= greatest(2, ceil(0.005 * (SELECT count(*) FROM documents))))"""

_TIDY = r"regexp_replace(regexp_replace({0}, '\n{{3,}}', chr(10) || chr(10), 'g'), '^\n+|\n+$', '', 'g')"


def _boilerplate(docs):
    return cleaning.boilerplate_lines(docs, MIN_DOCS, MIN_SHARE)


@query(f"WITH {_LINES_SQL} SELECT line, n_docs FROM boiler")
def boilerplate_lines(spark, sf_dir):
    """Lines repeated over many documents."""
    return _boilerplate(fx.documents(spark, sf_dir))


@query(f"""WITH {_LINES_SQL}, kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS body FROM lines
  WHERE line NOT IN (SELECT line FROM boiler) GROUP BY 1)
SELECT doc_id, {_TIDY.format("coalesce(body, '')")} AS text FROM documents LEFT JOIN kept USING (doc_id)""")
def clean_text(spark, sf_dir):
    """Documents with tidy white space and without boilerplate lines."""
    docs = fx.documents(spark, sf_dir).select("doc_id", "text")
    return cleaning.clean_text(docs, _boilerplate(docs))


_ODD_SQL = "odd AS (SELECT doc_id // 3 AS doc_id, CASE WHEN doc_id % 10 = 7 THEN NULL ELSE text END AS text FROM documents)"


@query(f"""WITH {_ODD_SQL}, {_LINES_SQL}, numbered AS (SELECT *, row_number() OVER () AS n FROM odd),
kept AS (SELECT n, string_agg(line, chr(10) ORDER BY i) AS body FROM (SELECT n, i,
    trim(regexp_replace(string_split(text, chr(10))[i], '[ \\t\\r\\f]+', ' ', 'g'), ' ') AS line
  FROM (SELECT n, text, unnest(generate_series(1, len(string_split(text, chr(10))))) AS i FROM numbered))
  WHERE line NOT IN (SELECT line FROM boiler) GROUP BY 1)
SELECT doc_id, CASE WHEN text IS NOT NULL THEN {_TIDY.format("coalesce(body, '')")} END AS text
FROM numbered LEFT JOIN kept USING (n)""")
def clean_text_by_join(spark, sf_dir):
    """Null texts and repeated ids cleaned by the join that takes the place of the hash set for long lists of lines."""
    docs = fx.documents(spark, sf_dir).select("doc_id", "text")
    odd = docs.select(F.floor(F.col("doc_id") / 3).alias("doc_id"), F.expr("CASE WHEN doc_id % 10 <> 7 THEN text END").alias("text"))
    return cleaning.clean_text(odd, _boilerplate(docs), max_inline_lines=0)


_FIXED_SQL = """chunk AS (SELECT doc_id, i AS pos, substr(text, 1 + i * 800, 1000) AS text FROM (
  SELECT doc_id, text, unnest(generate_series(0, greatest(ceil((length(text) - 200) / 800.0), 1)::BIGINT - 1)) AS i
  FROM documents))"""


@query(f"""WITH {_FIXED_SQL}
SELECT doc_id, pos::INTEGER AS pos, text, sha256(concat_ws('|', doc_id, pos, text)) AS chunk_id FROM chunk""")
def chunk_fixed(spark, sf_dir):
    """Windows of 1000 characters overlapping by 200, with repeatable ids."""
    pieces = chunks.chunk_fixed(fx.documents(spark, sf_dir).select("doc_id", "text"))
    return chunks.with_metadata(pieces, F.lit("1")).select("doc_id", "pos", "text", "chunk_id")


@query()
def chunk_recursive(spark, sf_dir):
    """Chunks that end at line, word or character boundaries."""
    return chunks.chunk_recursive(fx.documents(spark, sf_dir).select("doc_id", "text"))


@query("""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \\t\\n\\f\\r\\x0B]+'), lambda x: x <> '') AS words
  FROM documents)
SELECT doc_id, i::INTEGER AS pos, array_to_string(words[1 + i * 525 : i * 525 + 600], ' ') AS text FROM (
  SELECT doc_id, words, unnest(generate_series(0, greatest(ceil((len(words) - 75) / 525.0), 1)::BIGINT - 1)) AS i
  FROM w WHERE len(words) > 0)""")
def chunk_tokens(spark, sf_dir):
    """Windows of 600 words overlapping by an eighth."""
    return chunks.chunk_tokens(fx.documents(spark, sf_dir).select("doc_id", "text"))


@query(f"""WITH {_FIXED_SQL}, tagged AS (SELECT lang, sha256(d.text) AS version,
    [t FOR t IN ['license', 'the', 'que'] IF contains(lower(c.text), t)] AS tags, length(c.text) AS n
  FROM chunk c JOIN documents d USING (doc_id))
SELECT lang, array_to_string(tags, ',') AS tags, count(*) AS n_chunks, count(DISTINCT version) AS n_versions,
  sum(n)::BIGINT AS n_chars FROM tagged GROUP BY 1, 2""")
def chunk_metadata(spark, sf_dir):
    """Version and tags of chunks, summed up."""
    docs = index.with_version(fx.documents(spark, sf_dir).select("doc_id", "lang", "text"))
    pieces = chunks.with_metadata(chunks.chunk_fixed(docs), F.col("version"), ["license", "the", "que"])
    return pieces.groupBy("lang", F.array_join("tags", ",").alias("tags")).agg(
        F.count(F.lit(1)).alias("n_chunks"), F.count_distinct("version").alias("n_versions"),
        F.sum(F.length("text")).alias("n_chars"))


@query("""WITH s AS (SELECT doc_id, generate_subscripts(parts, 1) AS section, unnest(parts) AS part FROM (
  SELECT doc_id, string_split('# ' || source || chr(10) || text, chr(10) || '# ') AS parts FROM (
    SELECT doc_id, source, replace(text, '. ', '.' || chr(10) || '# ') AS text FROM documents)))
SELECT doc_id, count(*) AS n_sections, count(DISTINCT ltrim(regexp_extract(part, '^(# +)?([^\\n]*)', 2), ' ')) AS n_titles
FROM s GROUP BY 1""")
def split_sections(spark, sf_dir):
    """Titled sections of documents in which every sentence after the first is made a title line."""
    docs = fx.documents(spark, sf_dir).select(
        "doc_id", F.concat(F.lit("# "), F.col("source"), F.lit("\n"),
                           F.replace("text", F.lit(". "), F.lit(".\n# "))).alias("text"))
    sections = chunks.split_sections(docs)
    return sections.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_sections"),
        F.count_distinct(F.coalesce("section_title", F.lit(""))).alias("n_titles"))


# ---------------------------------------------------------------- intake

_RECORD_END = "\x1e"


@query("""SELECT 'txt' AS doc_type, sha256(text) AS version, count(*) AS n_rows, min(length(text)) AS n_chars
FROM documents GROUP BY 2""")
def document_intake(spark, sf_dir):
    """All documents written as text files, read back with source metadata."""
    path = scratch_path(spark, "intake")
    docs = fx.documents(spark, sf_dir)
    docs.select("text").write.option("lineSep", _RECORD_END).text(path)
    found = read_documents(spark, path, separator=_RECORD_END)
    return found.where(F.col("source_path").contains("part-")).groupBy("doc_type", "version").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(F.length("text")).cast("bigint").alias("n_chars"))


# ---------------------------------------------------------------- incremental index

def _index_pair(spark, sf_dir):
    """(index of yesterday, documents of today) by ``doc_id, version, text``.

    Yesterday had no Spanish documents, German ones with another beginning, and the benchmark items, which are gone.
    """
    docs = fx.documents(spark, sf_dir).select("doc_id", "lang", "text")
    before = docs.where("lang <> 'es'").withColumn(
        "text", F.when(F.col("lang") == "de", F.concat(F.lit("Entwurf: "), F.col("text"))).otherwise(F.col("text"))).drop("lang")
    gone = fx.table(spark, sf_dir, "benchmark").select((-F.col("item_id") - 1).alias("doc_id"), "text")
    return (index.with_version(before.unionByName(gone)), index.with_version(docs.drop("lang")))


_PAIR_SQL = """indexed AS (SELECT doc_id, CASE WHEN lang = 'de' THEN 'Entwurf: ' || text ELSE text END AS text FROM documents
    WHERE lang <> 'es' UNION ALL SELECT -item_id - 1, text FROM benchmark),
delta AS (SELECT doc_id, CASE WHEN i.text IS NULL THEN 'new' WHEN d.text IS NULL THEN 'deleted'
    WHEN i.text = d.text THEN 'same' ELSE 'changed' END AS change
  FROM indexed i FULL JOIN documents d USING (doc_id))"""


@query(f"WITH {_PAIR_SQL} SELECT doc_id, change FROM delta")
def index_delta(spark, sf_dir):
    """Documents that are new, changed, deleted or the same."""
    return index.index_delta(*_index_pair(spark, sf_dir))


@query("SELECT doc_id, sha256(text) AS version, length(text) AS n_chars FROM documents")
def index_apply_delta(spark, sf_dir):
    """The index after re-indexing only what changed equals an index built anew."""
    renewed = index.apply_delta(*_index_pair(spark, sf_dir))
    return renewed.select("doc_id", "version", F.length("text").cast("bigint").alias("n_chars"))


@query(f"""WITH {_PAIR_SQL}
SELECT 1 AS snapshot, count(*) AS n_docs, sum(length(text))::BIGINT AS n_chars FROM indexed
UNION ALL SELECT 2, count(*), sum(length(text))::BIGINT FROM documents""")
def index_snapshot(spark, sf_dir):
    """Two snapshots of an index, each read on its own."""
    before, now = _index_pair(spark, sf_dir)
    path = scratch_path(spark, "snapshots")
    index.write_snapshot(before, path, 1)
    index.write_snapshot(index.apply_delta(index.read_snapshot(spark, path, 1), now), path, 2)
    parts = [
        index.read_snapshot(spark, path, i).agg(
            F.lit(i).alias("snapshot"), F.count(F.lit(1)).alias("n_docs"), F.sum(F.length("text")).alias("n_chars"))
        for i in (1, 2)
    ]
    return parts[0].unionByName(parts[1])


# After the first indexing a third of the documents get a sentence more, a tenth go, and copies of others come.
_LATER = """(SELECT doc_id, CASE WHEN doc_id % 3 = 1 THEN text || ' One more sentence.' ELSE text END AS text
  FROM documents WHERE doc_id % 10 <> 4
  UNION ALL SELECT doc_id + 1000000000, text FROM documents WHERE doc_id % 10 = 4)"""


def _hashes_sql(rows: str) -> str:
    return f"""(SELECT doc_id, doc_id || '-' || i AS item_id, sha256(substr(text, 1 + i * 800, 1000)) AS hash FROM (
    SELECT doc_id, text, unnest(generate_series(0, greatest(ceil((length(text) - 200) / 800.0), 1)::BIGINT - 1)) AS i FROM {rows}))"""


@query(f"""WITH a AS {_hashes_sql('documents')}, b AS {_hashes_sql(_LATER)}
SELECT 1 AS step, count(*) AS n_items, count(DISTINCT hash) AS n_hashes, count(DISTINCT hash) AS n_embedded FROM a
UNION ALL SELECT 2, count(*), count(DISTINCT hash),
  count(DISTINCT CASE WHEN hash NOT IN (SELECT hash FROM a) THEN hash END) FROM b
UNION ALL SELECT 3, count(*), count(DISTINCT hash), 0 FROM a""")
def index_reembed(spark, sf_dir):
    """A vector index of all documents, brought up to date with changed ones and then set back: how many chunks it holds
    and how many texts were embedded at each step."""
    docs = fx.documents(spark, sf_dir).select("doc_id", "text")
    longer = F.when(F.col("doc_id") % 3 == 1, F.concat("text", F.lit(" One more sentence."))).otherwise(F.col("text"))
    tenth = F.col("doc_id") % 10 == 4
    later = docs.where(~tenth).select("doc_id", longer.alias("text")).unionByName(
        docs.where(tenth).withColumn("doc_id", F.col("doc_id") + 1_000_000_000))
    store = VectorStore(spark, scratch_path(spark, "vectors"), chunks.chunk_fixed, retrieval.embed)
    steps = [store.update(docs), store.update(later)]
    steps.append(store.restore(steps[0]))
    return tables.union_all([
        store.items(n).agg(F.lit(i).alias("step"), F.count(F.lit(1)).alias("n_items"), F.count_distinct("hash").alias("n_hashes"),
                           F.lit(store.manifest(n)["embedded"]).cast("bigint").alias("n_embedded"))
        for i, n in enumerate(steps, 1)])
