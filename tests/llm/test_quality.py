"""Quality statistics and learned decision lists against plain Python."""

import random
import re
from collections import Counter

import numpy as np
from helpers import LONG, ODD, docs
from pyspark.sql import functions as F

from wattlake.llm import quality, queries
from wattlake.llm.common import read

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    inside = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_marks": len(re.findall(r"[!?.,;:]", text)), "n_digits": len(re.findall("[0-9]", text)),
        "n_upper": len(re.findall("[A-Z]", text)), "n_distinct": len(set(words)), "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside),
        "n_same_next": sum(a == b for a, b in zip(words, words[1:])),
    }


def texts(n=300):
    draw = random.Random(5)
    for i in range(n):
        vocabulary = ["a", "ß", "#x|", "q r", "z\x1cy", "Ü12!"][:draw.randint(1, 6)]
        yield i, "".join(draw.choice(vocabulary) + draw.choice([" ", "  ", "\n", "\t", "\r\n"]) for _ in range(draw.randint(0, 60)))


def test_statistics_equal_brute_force(spark):
    rows = [(i, t, None) for i, t in texts()]
    got = quality.statistics(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    wanted = {i: counted(t) for i, t, _ in rows}
    assert all({c: r[c] for c in quality.COUNTS} == wanted[r.doc_id] for r in got)


def test_odd_rows_and_no_rows(spark):
    got = sorted((str(r.doc_id), r.n_words, r.n_repeat_words) for r in quality.statistics(docs(spark, ODD)).collect())
    want = sorted((str(i), (c := counted(t))["n_words"], c["n_repeat_words"]) for i, t, _ in ODD)
    assert got == want
    assert counted(LONG)["n_repeat_words"] == 60_000
    empty = quality.statistics(docs(spark, []))
    assert empty.count() == 0
    assert quality.learn(empty, spark.createDataFrame([], "doc_id long, quality int")).rules == ()


def test_windows_with_one_key_are_compared(monkeypatch):
    import pyarrow as pa

    words = quality.Words(pa.array(["a b c d e f g h i j k a b c d e f g h", "a b c d e f g h"], pa.large_string()))
    real = np.argsort
    monkeypatch.setattr(quality.np, "argsort", lambda key, kind=None: (key.__imul__(0), real(key, kind=kind))[1])
    assert quality._repeated(words).tolist() == [True] * 8 + [False] * 3 + [True] * 8 + [False] * 8


def test_rules_are_learned_in_order_and_mean_the_same_in_spark(spark):
    draw = np.random.default_rng(3)
    n = 3000
    rows = [(i, int(w), int(w * 5), int(w * s), 0, 0, 0, int(w * d), 10, 0, 0, 0) for i, (w, s, d) in enumerate(zip(
        draw.integers(20, 400, n), draw.uniform(0, 1, n), draw.uniform(0.1, 1, n)))]
    counts = spark.createDataFrame(rows, "doc_id long, " + ", ".join(f"{c} long" for c in quality.COUNTS))
    marked = counts.withColumns({s: quality.share(s) for s in quality.SHARES})
    bad = (F.col("symbol_share") > 0.15) | ((F.col("distinct_by_root") < 5) & (F.col("symbol_share") < 0.05))
    labels = marked.select("doc_id", (~bad).cast("int").alias("quality"))
    found = quality.learn(counts, labels)
    assert 2 <= len(found.rules) <= 8 and "symbol_share > 0.1" in str(found.rules[0])
    told = marked.select(bad.alias("bad"), found.keeps().alias("kept"), found.first_match().alias("rule"),
                         *quality.SHARES).toPandas()
    assert (told.bad != told.kept).mean() > 0.97
    values = {s: told[s].to_numpy() for s in quality.SHARES}
    first = np.zeros(n, int)
    for number, rule in reversed(list(enumerate(found.rules, 1))):
        first = np.where(rule.holds(values), number, first)
    assert (told.rule.fillna(0).to_numpy() == first).all()
    assert found == quality.learn(counts.repartition(7), labels)


def test_labels_without_both_kinds_or_documents_teach_nothing(spark):
    counts = quality.statistics(docs(spark, [(i, f"word {i}", None) for i in range(50)]))
    one_kind = spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, quality int")
    strangers = spark.createDataFrame([(1000 + i, i % 2) for i in range(50)] + [(None, 0), (1, None)], "doc_id long, quality int")
    for labels in (one_kind, strangers):
        found = quality.learn(counts, labels)
        assert found.rules == () and counts.where(found.keeps()).count() == 50


def test_sample_is_bounded_and_held_out_rows_are_judged_well(spark):
    folder = "/root/testdata/sf0.01"
    counts = quality.statistics(read(spark, folder, "documents")).cache()
    labels = read(spark, folder, "labels")
    third = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    found = quality.learn(counts, labels.where(~third))
    assert quality.learn(counts, labels, sample_rows=40) == quality.learn(counts, labels, sample_rows=40)
    judged = counts.join(labels.where(third), "doc_id").select("quality", found.keeps().cast("int").alias("kept")).toPandas()
    good = judged[judged.quality == 1]
    assert good.kept.mean() > 0.97 and (judged.kept == judged.quality).mean() > 0.9


def test_query_equals_brute_force(spark, sf_dir):
    texts_of = {r.doc_id: r.text for r in read(spark, sf_dir, "documents").collect()}
    rows = queries.op13_quality_rules(spark, sf_dir).collect()
    assert len(rows) == len(texts_of)
    for r in rows:
        c = counted(texts_of[r.doc_id])
        assert [r[x] for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] == [
            c[x] for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
        assert r.base_failed == (c["n_words"] < 20 or 100 * c["n_repeat_words"] > 30 * c["n_words"])
        assert r.kept == (not r.base_failed and r.rule is None)


