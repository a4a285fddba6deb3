"""Periodic runs against a search of all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from helpers import LONG, ODD, docs

from wattlake.llm import periods, queries
from wattlake.llm.common import read

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=24):
    """All runs as (start, length, period): for every period, the stretches in which words a period apart are equal."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 3 * q):
                found.setdefault((i, j + q), q)  # a smaller period of the same stretch came before
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def without_repeats(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def sequences(n):
    draw = random.Random(1)
    for _ in range(n):
        k = draw.choice([1, 2, 2, 3, 5, 40])
        words = [draw.randrange(k) for _ in range(draw.randint(0, 200))]
        for _ in range(draw.randint(0, 4)):
            phrase = [draw.randrange(k) for _ in range(draw.randint(1, 40))]
            at = draw.randint(0, len(words))
            words[at:at] = (phrase * draw.randint(2, 6))[:draw.randint(1, 200)]
        if draw.random() < 0.2:
            words = ([0] * draw.randint(1, 30) + [1]) * draw.randint(2, 8) + words
        yield words


def test_transform_gives_exact_correlations():
    draw = np.random.default_rng(2)
    for size, reach in ((1, 1), (1, 4), (8, 22), (16, 31), (64, 127)):
        block, window = draw.integers(0, 5000, (7, size)), draw.integers(0, 5000, (7, reach))
        got = periods.correlations(block.astype(np.uint64), window.astype(np.uint64))
        want = np.array([[int(b @ w[s:s + size]) for s in range(reach - size + 1)] for b, w in zip(block, window)])
        assert (got.astype(np.int64) == want).all()


@pytest.mark.parametrize("least", [3, 7, 24, 50])
def test_all_runs_are_found(least):
    for words in sequences(300):
        start, end, period = periods.find_runs(np.array(words, np.int64), len(words), least)
        assert list(zip(start.tolist(), (end - start).tolist(), period.tolist())) == brute(words, least)


def test_words_that_fall_together_when_reduced_are_told_apart(monkeypatch):
    monkeypatch.setattr(periods, "isqrt", lambda _: 2)  # all words look like one of two
    monkeypatch.setattr(periods, "_HASH_PRIME", np.uint64(3))  # and nearly all stretches have one fingerprint
    for words in sequences(150):
        start, end, period = periods.find_runs(np.array(words, np.int64), len(words))
        assert list(zip(start.tolist(), (end - start).tolist(), period.tolist())) == brute(words)


def test_long_sequences_take_little_time():
    n = 400_000
    for words in (np.zeros(n, np.int64), np.array(([0] * 2000 + [1]) * 100), np.tile(np.arange(n // 4), 4)):
        start, end, _ = periods.find_runs(words, len(words))
        assert (start.min(), end.max()) == (0, len(words))


def test_operator_equals_brute_force(spark):
    draw = random.Random(4)
    names = ["a", "b", "über", "x\x1cy", "q r", "-"] + [f"w{i}" for i in range(40)]
    rows = [(i, draw.choice(["", " ", "\n"]) + "".join(names[w] + draw.choice([" ", "  ", "\n", "\t", "\r\n"]) for w in words), None)
            for i, words in enumerate(sequences(150))] + [(1000 + i, t, x) for i, t, x in ODD if i]
    got = {r.doc_id: r for r in periods.collapse(docs(spark, rows).repartition(3)).collect()}
    for i, text, _ in rows:
        words = WORD.findall(text or "")
        runs = brute(words) if len(words) < 2000 else [(0, 60_000, 3)]
        assert [tuple(r) for r in got[i].runs] == runs
        assert (got[i].n_words, got[i].collapsed) == (len(words), without_repeats(words, runs))


def test_odd_rows_and_no_rows(spark):
    got = periods.collapse(docs(spark, ODD)).collect()
    assert len(got) == len(ODD)
    assert {r.collapsed for r in got if r.doc_id == 6} == {"lorem ipsum dolor"}
    assert all(r.runs == [] and r.collapsed == " ".join(WORD.findall(r.collapsed)) for r in got if r.doc_id != 6)
    assert LONG and periods.collapse(docs(spark, [])).count() == 0


def expected(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    best = (None,) * 4
    if runs:
        s, length, q = min(runs, key=lambda r: (-r[1] * 10**12 // r[2], r[0], r[2]))
        best = (s, length, q, 1000 * length // q)
    told = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (len(runs), *best, sha(told), sha(without_repeats(words, runs)))


def test_query_equals_brute_force(spark, sf_dir):
    rows = {r.doc_id: r for r in queries.op11_periodic_runs(spark, sf_dir).collect()}
    texts = read(spark, sf_dir, "documents").collect()
    assert len(rows) == len(texts)
    checked = [d for d in texts if len(d.text or "") < 6000]
    for d in checked:
        r = rows[d.doc_id]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == expected(
            d.doc_id, d.text)
    assert len(checked) > 0.8 * len(texts) and any(r.n_runs for r in rows.values())
