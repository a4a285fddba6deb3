"""The registered queries of this subpackage: one per operator, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import (chats, langid, licences, manifest, merkle, packing, periods, pii, quality, sentencepieces, sharding,
                          simhash, sql, topk)
from wattlake.llm.common import read, stored


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; documents whose id has remainder 2 are never learned from."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    remainder = F.pmod(langid.crc_of_id(), F.lit(4))
    model = langid.train(docs.where(remainder != 2))
    held_out = F.coalesce(remainder == 2, F.lit(False)).alias("held_out")
    return langid.predict(docs, model).select("doc_id", held_out, "lang_pred", "score", "rejected")


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts of the base kinds, a digest of their spans, and all spans."""
    found = pii.find_spans(read(spark, sf_dir, "documents"))
    counts = [pii.counted(F.col("spans"), k).alias(f"n_{k}") for k in pii.BASE]
    base = pii.listed(pii.base_only(F.col("spans")))
    return found.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"),
                        pii.listed(F.col("spans")).alias("spans"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, tokenized and packed into sequences of 2048 tokens."""
    return packed(read(spark, sf_dir, "documents"))


def packed(docs: DataFrame, capacity: int = 2048, cache_bytes: int | None = None) -> DataFrame:
    """Pieces with a checksum of their ids, and their places."""
    cut = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity, cache_bytes=cache_bytes)
    sums = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(sums, capacity)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard, of 64, of every document."""
    shards = [f"shard-{i:02d}" for i in range(64)]
    return sharding.place(read(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], shards)


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five rows with the highest inner products for every fiftieth id."""
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, factor=256)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), words=3, max_distance=3)
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its text with the last third taken from the next document."""
    rows = merkle.with_next(read(spark, sf_dir, "documents"))
    edited = rows.withColumn("edited", merkle.spliced(F.col("text"), F.col("next_text")))
    trees = edited.withColumn("edited_tree", merkle.tree(F.col("edited")))
    return trees.select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.col("tree.fingerprint").alias("fingerprint"), F.col("edited_tree.fingerprint").alias("edited_fingerprint"),
        merkle.likeness(F.col("tree"), F.col("edited_tree")).alias("near_edited"),
        merkle.likeness(F.col("tree"), F.col("next_tree")).alias("near_next"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best segmentations of every document, with checksums of their ids and of the text they decode to."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    found = sentencepieces.encode(read(spark, sf_dir, "documents"), model, n=3, decoded=True)
    return found.select("doc_id", "rank", "score", "n_pieces", F.crc32("ids").alias("ids_crc32"),
                        F.crc32(F.col("text").cast("binary")).alias("text_crc32"))


def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical digest of every document, the licence it is the text of, and the licences its lines name."""
    found = licences.scan(read(spark, sf_dir, "documents"))
    return found.withColumn("notices", F.array_join("notices", ","))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message without its quotes, with the message it answers and its thread."""
    return chats.conversations(read(spark, sf_dir, "conversations"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, after a phrase was made to repeat in a tenth of them."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    h = langid.crc_of_id()
    g = F.floor(h / 10)
    repeated = periods.repeated_tail(F.col("text"), lambda n: g % n,
                                     lambda n, start: F.lit(1) + F.floor((n - start) / (F.lit(3) + g % 8)))
    text = F.coalesce(F.when(h % 10 == 0, repeated), F.col("text"))
    found = periods.collapse(docs.withColumn("text", text))
    best = found.withColumn("best", periods.strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents by source, and every proof folded from a leaf whose text was put in lower case for a fifth."""
    docs = read(spark, sf_dir, "documents")
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = (langid.crc_of_id() % 5 == 0) & (lower != F.col("text"))
    leaves = docs.select("doc_id", "source", manifest.row_digest(*head, F.col("text")).alias("leaf"),
                         F.when(tampered, manifest.row_digest(*head, lower)).alias("tampered_leaf"))
    proven = manifest.manifest(leaves, "source", "doc_id", "leaf")
    folded = manifest.folded(F.coalesce("tampered_leaf", "leaf"), F.col("proof"))
    return proven.select(
        "doc_id", "leaf", "subroot", "root", manifest.digest(manifest.siblings_of(F.col("proof"))).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document, and whether it passes the base rules and the learned decision list."""
    counts = stored(quality.statistics(read(spark, sf_dir, "documents")), "counts")
    rules = quality.learn(counts, read(spark, sf_dir, "labels"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return counts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & rules.keeps()).alias("kept"), rules.first_match().alias("rule"))


QUERIES = [op1_language_id, op2_personal_data, op3_best_fit_packing, op4_sharding, op5_exact_top_k, op6_simhash_near_dedup,
           op7_document_fingerprints, op8_sentencepiece, op9_licence_scan, op10_chat_formatting, op11_periodic_runs,
           op12_dataset_manifest, op13_quality_rules]
SQL = {
    "op2_personal_data": sql.personal_data(),
    "op5_exact_top_k": sql.TOP_K,
    "op7_document_fingerprints": sql.fingerprints(),
    "op9_licence_scan": sql.licence_scan(),
    "op10_chat_formatting": sql.chat_conversations(),
    "op12_dataset_manifest": sql.dataset_manifest(),
}
