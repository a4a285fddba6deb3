import random
from array import array

import public_tokenizers
import pyarrow as pa
import pytest
from helpers import LONG, ODD, docs

from wattlake.llm import queries, sentencepieces
from wattlake.llm.sentencepieces import BLANK, Vocabulary

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(PATH)


def brute(v, text):
    """Every segmentation as (score, ids)."""
    marks = [(BLANK, False) if c == " " else (c, c == BLANK) for c in (" " + text if text else "")]
    found = []

    def go_on(i, score, ids):
        if i == len(marks):
            found.append((score, ids))
            return
        if marks[i][1] or marks[i][0] not in v.edges:
            more, piece = v.spelled(marks[i][0])
            go_on(i + 1, score + more, ids + piece)
            return
        for j in range(i + 1, min(len(marks), i + 16) + 1):
            edge = None if any(m[1] for m in marks[i:j]) else v.edges.get("".join(m[0] for m in marks[i:j]))
            if edge:
                go_on(j, score + edge[0], ids + edge[1])
    go_on(0, 0, b"")
    return found


@pytest.mark.parametrize("n", [1, 3, 6])
def test_nbest_equals_all_segmentations(vocabulary, n):
    rng = random.Random(n)
    texts = ["", " ", "  ", "\n", "a\n\nb", "hello the", "▁", "a▁b", "\n▁", "😀"]
    texts += ["".join(rng.choice("ab te\n▁é😀th in0") for _ in range(rng.randint(0, 9))) for _ in range(1000)]
    for text in texts:
        got, every = vocabulary.nbest(text, n), brute(vocabulary, text)
        assert [g[0] for g in got] == sorted((s for s, _ in every), reverse=True)[:n]
        assert len({g[2] for g in got}) == len(got) and {(g[0], g[2]) for g in got} <= set(every)
        assert all(vocabulary.decode(g[2]) == text and g[1] == len(array("I", g[2])) for g in got)


def test_ties_and_long_words(vocabulary):
    for text in ("a" * 20_000, "ab " * 5_000, LONG):
        for _, _, ids in vocabulary.nbest(text, 3):
            assert vocabulary.decode(ids) == text


def test_full_cache_changes_nothing(vocabulary, monkeypatch):
    texts = [f"word{i} and other{i % 5}" for i in range(100)]
    monkeypatch.setattr(sentencepieces, "CACHED_BYTES", 3000)
    small, sizes = Vocabulary(PATH), []
    for text in texts:
        assert small.nbest(text, 3) == vocabulary.nbest(text, 3)
        sizes.append(small.size)
    assert max(sizes) < 3000 + 6 * 300 and sizes != sorted(sizes)


def test_edges_that_are_not_held_change_nothing(vocabulary, monkeypatch):
    rng = random.Random(9)
    words = ["".join(rng.choice("abthe▁é😀in0") for _ in range(rng.randint(1, 30))) for _ in range(300)]
    want = [[(score, ids) for score, _, ids in vocabulary.nbest(w, 4)] for w in words]
    monkeypatch.setattr(sentencepieces, "HELD", 2)
    lean = Vocabulary(PATH)
    assert [[(score, ids) for score, _, ids in lean.nbest(w, 4)] for w in words] == want


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyzABCDEFGHIJ0123456789+/", "a", "的一是不了人我在有他😀"])
def test_a_long_text_without_blanks_takes_little_memory(vocabulary, letters):
    import tracemalloc
    rng = random.Random(2)
    text = "".join(rng.choices(letters, k=300_000))  # the memory is in proportion: three million take ten times as much
    vocabulary.forget()
    tracemalloc.start()
    found = list(vocabulary.encode(pa.array([text], pa.large_string()), 3))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == (3 if letters.isascii() else 1) and all(f[4].decode() == " " + text for f in found)
    assert peak < 120 * len(text.encode())
    vocabulary.forget()


def test_odd_rows(spark):
    rows = docs(spark, ODD)
    found = sentencepieces.encode(rows, PATH, 2)
    got = sentencepieces.decode(found, PATH).collect()
    texts = {(i, t or "") for i, t, _ in ODD}
    assert {(r.doc_id, r.text) for r in got} == texts
    assert sum(r["rank"] == 1 for r in got) == len(ODD)
    assert all(r.n_pieces == 0 and r["rank"] == 1 for r in got if r.text == "")
    assert sentencepieces.encode(docs(spark, []), PATH).count() == 0
    nulls = spark.createDataFrame([(None, "x")], "ids binary, text string")
    assert sentencepieces.decode(nulls, PATH).head().text is None


def test_query_round_trip(spark, sf_dir):
    import zlib
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op8_sentencepiece(spark, sf_dir).collect()
    assert {r.doc_id for r in got} == set(texts) and len(got) <= 3 * len(texts)
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in got)
    best = {r.doc_id: r.score for r in got if r["rank"] == 1}
    assert all(r.score <= best[r.doc_id] for r in got)
