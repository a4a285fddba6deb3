"""From raw documents to packed training sequences.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir) and gives the documents that the
next one gets, the last one the packed pieces. ``run`` stores the result of each stage in the shared folder.
SQL can express neither the trained classifier nor the tokenizer, so the stages are tested against brute force.

Defined cases, for all stages: a null text and an empty one have no letters, so the first stage drops them; later stages, on
their own, take them as empty. Texts of any length are read whole. Repeated rows and ids are rows of their own, of which near_dedup
keeps one per group, with the smallest id; a null id comes last. No rows give no rows. Further columns pass through all stages but
the last, whatever their names; ``n_chars`` is brought up to date where it is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import langid, pii, queries, simhash
from wattlake.llm.common import read, stored

ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier is sure enough of. It learns from the languages these documents state,
    as the query of the operator does, and without the quarter of ids kept for measuring it."""
    model = langid.train(docs.where(F.pmod(langid.crc_of_id(), F.lit(4)) != 2))
    return langid.keep_identified(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return simhash.keep_first(docs, words=3, max_distance=3)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced in their texts, and ``n_chars``, if there, that fits the new texts."""
    clean = docs.withColumn("text", pii.redact(F.col("text")))
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, packed into sequences of 2048 tokens. Workers keep few words, as they still hold memory of
    the stages before."""
    return queries.packed(docs, cache_bytes=24 << 20)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("personal_data", personal_data),
          ("best_fit_packing", best_fit_packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
