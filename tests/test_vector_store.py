"""The vector index against one made from nothing, and what its updates embed."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlake.operators import chunks, retrieval
from wattlake.operators.vector_store import StoreConflict, VectorStore


def documents(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")




def store_of(spark, path):
    cut = lambda docs: chunks.chunk_fixed(docs, 40, 10)
    return VectorStore(spark, str(path), cut, retrieval.embed)


def content(store, snapshot=None):
    return {r.item_id: (r.doc_id, r.pos, r.hash, tuple(np.round(r.embedding, 9))) for r in store.items(snapshot).collect()}


def made_anew(spark, path, texts):
    store = store_of(spark, path)
    store.update(documents(spark, texts))
    return content(store)


def test_updates_equal_an_index_made_anew(spark, tmp_path):
    draw = random.Random(1)
    word = lambda: draw.choice(["wind", "solar", "hydro", "coal", "price", "grid"])
    texts = {i: " ".join(word() for _ in range(draw.randint(0, 40))) for i in range(12)}
    store, seen = store_of(spark, tmp_path / "store"), []
    for step in range(5):
        if step:
            for i in draw.sample(sorted(texts), 3):
                texts[i] += " " + word()
            texts.pop(draw.choice(sorted(texts)))
            texts[100 + step] = texts[draw.choice(sorted(texts))]  # a copy of another
        if step == 3:
            texts[0] = "back again"
        seen.append((store.update(documents(spark, texts)), dict(texts)))
        assert content(store) == made_anew(spark, tmp_path / f"anew{step}", texts)
        assert {r.doc_id for r in store.documents().collect()} == set(texts)
    for snapshot, then in seen:
        assert content(store, snapshot) == made_anew(spark, tmp_path / f"again{snapshot}", then)
    store.restore(seen[1][0])
    assert content(store) == content(store, seen[1][0])
    store.update(documents(spark, texts))
    assert content(store) == content(store, seen[-1][0])


def test_only_new_texts_are_embedded(spark, tmp_path):
    store = store_of(spark, tmp_path / "store")
    long = "".join(f"part {i:03d} of a long text. " for i in range(40))
    texts = {1: long, 2: "short", 3: "short", 4: None, 5: ""}
    first = store.update(documents(spark, texts))
    n = store.items().where("doc_id = 1").count()
    assert store.manifest(first)["embedded"] == n + 2  # each different text once: the empty one is a text too
    assert store.update(documents(spark, texts)) == first  # nothing changed
    texts[1] = long + "And an end."
    second = store.update(documents(spark, texts))
    assert store.manifest(second)["embedded"] <= 2  # the last chunk, and one more
    texts[6], texts[2] = long, "And an end."
    third = store.update(documents(spark, texts))
    assert store.manifest(third)["embedded"] <= 2  # what the first snapshot had is not there any more, the rest is
    assert store.items(first).where("doc_id = 1").count() == n
    assert set(store.documents().select("doc_id").toPandas().doc_id) == {1, 2, 3, 4, 5, 6}


def test_writers_cannot_overwrite_each_other(spark, tmp_path):
    mine, other = (store_of(spark, tmp_path / "store") for _ in range(2))
    mine.update(documents(spark, {1: "a"}))
    overtaken = other.cut

    def cut(docs):
        mine.update(documents(spark, {1: "a", 2: "b"}))
        return overtaken(docs)

    other.cut = cut
    with pytest.raises(StoreConflict):
        other.update(documents(spark, {3: "c"}))
    assert {r.doc_id for r in mine.items().collect()} == {1, 2}


def test_compaction_and_search(spark, tmp_path, monkeypatch):
    store = store_of(spark, tmp_path / "store")
    for i in range(4):
        store.update(documents(spark, {j: f"text {j} {'x' * (i == j)}" for j in range(4)}))
    before = content(store)
    assert store.compact() == store.log.last() and len(store.manifest()["chunks"]) == 4
    monkeypatch.setattr("wattlake.operators.vector_store.COMPACT_AFTER", 2)
    store.compact()
    assert content(store) == before and len(store.manifest()["chunks"]) == 1 and store.documents().count() == 4
    queries = retrieval.embed(spark.createDataFrame([(1, "text 3 x")], "query_id long, text string"))
    assert retrieval.top_k(queries, store.items(), 1).first().item_id == "3-0"
    store.update(documents(spark, {9: "other"}))
    assert store.items().select(F.max("doc_id")).first()[0] == 9 and store.items().count() == 1


def test_only_vectors_of_shared_texts_move(spark, tmp_path):
    store = store_of(spark, tmp_path / "store")
    first = store.update(documents(spark, {1: "one", 2: "two", 3: "both", 4: "both", 5: "two more"}))
    raw = spark.read.parquet(f"{store.path}/{store.manifest()['chunks'][0][1]}")
    assert raw.where("item_id IS NULL").count() == 1 and store.items().count() == 5  # one text is held by two chunks
    assert store.manifest()["gone"] == [] and store.manifest()["embedded"] == 4
    store.update(documents(spark, {1: "two", 3: "both", 4: "new", 6: "new", 7: "one"}))
    assert store.manifest()["embedded"] == 1
    assert sorted((r.item_id, r.hash) for r in store.items().collect()) == sorted(
        (r.item_id, r.hash) for r in made_anew_items(spark, tmp_path / "anew", {1: "two", 3: "both", 4: "new", 6: "new", 7: "one"}))
    assert store.items(first).count() == 5


def made_anew_items(spark, path, texts):
    store = store_of(spark, path)
    store.update(documents(spark, texts))
    return store.items().collect()
