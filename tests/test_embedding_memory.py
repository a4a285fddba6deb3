"""What a Python worker holds at a time, whatever the size of Spark's batches."""

import numpy as np
import pandas as pd

from wattlake.operators import retrieval


def test_texts_are_embedded_some_at_a_time(spark):
    def model(texts):
        return [np.array([float(len(texts)), float(len(t))]) for t in texts]

    rows = spark.range(3000, numPartitions=1).selectExpr("id", "repeat('x', cast(id as int)) AS text")
    found = retrieval.embed(rows, model=model).collect()
    assert sorted((r.id, int(r.embedding[1])) for r in found) == [(i, i) for i in range(3000)]
    assert max(r.embedding[0] for r in found) <= retrieval.ROWS_AT_ONCE


def test_the_words_a_worker_keeps_are_bounded(monkeypatch):
    monkeypatch.setattr(retrieval, "_CACHED_WORDS", 10)
    words = [f"w{i}" for i in range(100)] + ["y" * 1000]
    retrieval._buckets.clear()
    once = retrieval.hashed_vectors(pd.Series([" ".join(words), None, "w1 w1"]))
    kept = retrieval._buckets[retrieval.DIMENSIONS]
    assert len(kept) <= 10 and max(map(len, kept)) <= 64
    assert abs(once[0].dot(once[0]) - 1) < 1e-9 and not once[1].any() and once[2].max() == 1
    retrieval._buckets.clear()


def test_each_different_word_is_hashed_once(monkeypatch):
    made, md5 = [], retrieval.hashlib.md5
    monkeypatch.setattr(retrieval.hashlib, "md5", lambda b: made.append(b) or md5(b))
    retrieval._buckets.clear()
    retrieval.hashed_vectors(pd.Series([f"{'y' * 1000} " * 50, "y" * 1000]))
    assert len(made) == 1
    retrieval._buckets.clear()


def test_vectors_equal_counts_of_words_one_by_one(monkeypatch):
    def plain(text):
        counts = np.zeros(256, np.int64)
        for word in retrieval._WORD.findall((text or "").lower()):
            counts[int.from_bytes(retrieval.hashlib.md5(word.encode()).digest()[:4], "big") % 256] += 1
        norm = np.sqrt(float((counts * counts).sum()))
        return counts / norm if norm else counts.astype(np.float64)

    texts = ["", None, "a", " a_b-c\n\u00e9t\u00e9 ", "\u0130stanbul \u039f\u0394\u039f\u03a3 \U0001d7d8\U00020000 x", "\n", "stra\u00dfe " * 300, "one two", "\u0301x", "\u039f\u03a3"]
    for chars in (1 << 20, 8):
        monkeypatch.setattr(retrieval, "_CHARS_AT_ONCE", chars)
        found = retrieval.hashed_vectors(pd.Series(texts, dtype=object))
        assert len(found) == len(texts) and all((a == plain(t)).all() for a, t in zip(found, texts))
    assert retrieval.hashed_vectors(pd.Series([], dtype=object)) == []
