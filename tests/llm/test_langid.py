import random

import numpy as np
import pytest
from helpers import ODD, docs
from pyspark.sql import functions as F

from wattlake.llm import langid, queries

WORDS = {"aa": "baba dede gigi babade".split(), "bb": "xyxo zuxu yozo xuzu".split()}


def made(n, seed=0):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choices(WORDS[k], k=rng.randint(3, 30))), k) for i in range(n) for k in [rng.choice(list(WORDS))]]


def brute_subwords(text):
    """All subwords as strings."""
    padded = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    found = [padded[i:i + 2] for i in range(len(padded) - 1) if padded[i:i + 2] != "  "]
    return found + [g for n in (3, 4) for g in (padded[i:i + n] for i in range(len(padded) - n + 1)) if " " not in g[1:-1]]


@pytest.mark.parametrize("text", ["", "a", "Ab c", "été, 12 x", "--", "a  b", "word"])
def test_subwords_are_those_of_words(text):
    got = np.concatenate(list(langid.subwords(text, 1 << 13))) if text else []
    want = brute_subwords(text)
    assert len(got) == (len(want) if text else 0)
    each = {s: int(np.concatenate(list(langid.subwords(s, 1 << 13)))[1]) for s in want if len(s) == 2 and " " not in s}
    assert set(each.values()) <= set(map(int, got))


def test_pieces_of_a_text_give_the_same_subwords(monkeypatch):
    text = "Some words, and éven more of them. " * 9
    whole = sorted(np.concatenate(list(langid.subwords(text, 1 << 13))).tolist())
    monkeypatch.setattr(langid, "PIECE_CHARS", 5)
    assert sorted(np.concatenate(list(langid.subwords(text, 1 << 13))).tolist()) == whole


def test_prediction_is_the_mean_embedding_under_the_softmax(spark):
    model = langid.train(docs(spark, made(300)))
    for _, text, _ in made(20, 5):
        at = np.concatenate(list(langid.subwords(text, len(model.weights))))
        logits = model.weights[at][:, :-1].astype(float).sum(axis=0) / len(at) / langid.SCALE / model.temperature
        p = np.exp(logits - logits.max())
        lang, score, _ = model.predict(text)
        assert lang == model.languages[int(p.argmax())] and score == pytest.approx((p / p.sum()).max())


def test_learns_rejects_and_repeats(spark):
    model = langid.train(docs(spark, made(300)))
    assert model.languages == ("aa", "bb")
    right = [model.predict(t)[0] == k for _, t, k in made(200, 9)]
    assert np.mean(right) > 0.98
    assert not any(model.predict(t)[2] for _, t, _ in made(200, 9))
    assert model.predict("привет всем людям")[2] and model.predict(None) == ("und", 0.0, True)
    again = langid.train(docs(spark, made(300)).repartition(7))
    assert (again.weights == model.weights).all() and again.temperature == model.temperature


def test_sample_is_bounded_and_balanced(spark):
    rows = [(i, "aa", "aa") for i in range(500)] + [(1000 + i, "bb", "bb") for i in range(20)]
    got = langid.sample(docs(spark, rows), 60, "doc_id", "text", "lang").collect()
    assert len(got) == 60 and sum(r.lang == "bb" for r in got) == 20


def test_odd_rows_and_no_labels(spark):
    model = langid.train(docs(spark, made(100)))
    got = langid.predict(docs(spark, ODD), model).collect()
    assert len(got) == len(ODD)
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (1, 2, 3, 7))
    none = langid.train(docs(spark, [(1, "text", None), (2, None, "en")]))
    assert none.languages == () and {r.lang_pred for r in langid.predict(docs(spark, ODD), none).collect()} == {"und"}
    assert langid.predict(docs(spark, []), model).count() == 0
    rows = ODD + [(100 + i, t, k) for i, t, k in made(5)]
    kept = langid.keep_identified(docs(spark, rows), model)
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == docs(spark, []).columns and {100, 101, 102, 103, 104} <= ids and not {1, 2, 3, 7} & ids


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    got = queries.op1_language_id(spark, folder).join(truth, "doc_id")
    held = got.where("held_out")
    assert held.count() == truth.where(F.pmod(langid.crc_of_id(), F.lit(4)) == 2).count()
    assert held.where("lang_pred = lang").count() / held.count() > 0.98
    assert got.where("rejected").count() <= 2


@pytest.mark.parametrize("out", ["de", "en", "es", "fr"])
def test_a_language_left_out_is_rejected_and_learned_ones_stay(spark, out):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    held = F.pmod(langid.crc_of_id(), F.lit(4)) == 2
    model = langid.train(rows.where(~held & (F.col("lang") != out)))
    new = [model.predict(r.text)[2] for r in rows.where(F.col("lang") == out).collect()]
    assert np.mean(new) > 0.9
    texts = [r.text for r in rows.where(held & (F.col("lang") != out)).orderBy("doc_id").collect()]
    mixed = [a[:400] + "\n" + b[:400] for a, b in zip(texts, texts[1:])]
    short = [" ".join(t.split()[:5]) for t in texts]
    for kept in (texts, mixed, short):
        assert np.mean([model.predict(t)[2] for t in kept]) < 0.02


def test_rejection_bound_follows_the_held_back_texts():
    assert langid._rejection(np.zeros(0), 0.001) == 0.5
    assert langid._rejection(np.zeros(999), 0.001) == pytest.approx(0.0005)
    some = np.linspace(0, 0.1, 1000)
    assert 0.1 <= langid._rejection(some, 0.001) <= langid._rejection(some * 2, 0.001)
    assert langid.least_unknown(np.array([1, 6]), np.array([12, 6])).tolist() == pytest.approx([-0.156, 1], abs=0.001)


def test_the_sample_is_bounded_in_bytes(spark):
    rows = [(i, f"{'abc' if i % 2 else 'xyz'} " * 100, "aa" if i % 2 else "bb") for i in range(60)]
    df = docs(spark, rows)
    whole, few = langid.train(df, steps=50), langid.train(df, steps=50, sample_bytes=10 * 8 * 3 * 400)
    assert whole.languages == few.languages == ("aa", "bb")
    sampled = langid.sample(df, 60, "doc_id", "text", "lang")
    assert langid._within_bytes(sampled, 60, 1 << 17, 10 * 8 * 3 * 400) == 10
    assert langid._within_bytes(sampled, 60, 1 << 17, 1) == 1 and langid._within_bytes(sampled, 60, 1 << 17, 1 << 40) == 60
    assert langid.train(docs(spark, []), steps=5).languages == ()
