import hashlib
import random
import re

from helpers import LONG, ODD, docs
from pyspark.sql import functions as F

from wattlake.llm import merkle, queries


def md5(x):
    return hashlib.md5(x.encode()).hexdigest()


def brute_tree(text):
    sections = [[(re.findall(r"[^.!?]{1,80}[.!?]*|[.!?]+", p)) for p in re.findall(r"[^\n]*\n|[^\n]+", s)]
                for s in re.findall(r"\n+|(?:[^\n]+\n?)+\n*", text)]
    root = md5("".join(md5("".join(md5("".join(map(md5, p))) for p in s)) for s in sections))
    key = lambda x: (int(md5(x)[:8], 16) << 16) + min(len(x), 65535)
    listed = ";".join(",".join("".join(f"{key(x):012x}" for x in p) for p in s) for s in sections)
    assert "".join(x for s in sections for p in s for x in p) == text
    return root, f"{root}:{listed}", {key(x) for s in sections for p in s for x in p}


def brute(rows):
    """Rows as (id, text); the expected result rows."""
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    found = []
    for n, (i, text) in enumerate(ordered):
        following = ordered[(n + 1) % len(ordered)][1]
        third = len(text) // 3
        edited = text[:len(text) - third] + following[:third]
        a, b, c = map(brute_tree, (text, edited, following))

        def like(x, y):
            weight = lambda keys: sum(k & 65535 for k in keys)
            return 1.0 if x[0] == y[0] else weight(x[2] & y[2]) / (max(weight(x[2]), weight(y[2])) + 1)
        found.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), a[1], b[1], like(a, b), like(a, c)))
    return sorted(found, key=str)


def run(spark, tmp_path, rows):
    docs(spark, [(i, t, None) for i, t in rows]).write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in queries.op7_document_fingerprints(spark, str(tmp_path)).collect()), key=str)


def test_random_texts(spark, tmp_path):
    rng = random.Random(1)
    parts = ["a b", ".", "!?", "\n", "\n\n", "é", "😀", "word " * 30, "x" * 90]
    rows = [(rng.randrange(10 ** 6), "".join(rng.choices(parts, k=rng.randint(0, 25)))) for _ in range(700)]
    rows = list(dict(rows).items())
    assert run(spark, tmp_path, rows) == brute(rows)


def test_odd_rows(spark, tmp_path):
    rows = [(i, t) for i, t, _ in ODD] + [(9, LONG + "."), (9, "b"), (9, "a")]
    assert run(spark, tmp_path, rows) == brute(rows)


def test_empty_and_single(spark, tmp_path):
    assert run(spark, tmp_path / "a", []) == []
    assert run(spark, tmp_path / "b", [(5, "only. one")]) == brute([(5, "only. one")])
    assert run(spark, tmp_path / "c", [(None, "x"), (None, "y")]) == brute([(None, "x"), (None, "y")])


def test_an_edit_shows_in_one_branch(spark):
    text = "One. Two.\nThree. Four.\n\nFive. Six.\nSeven."
    df = spark.createDataFrame([(text, text.replace("Six", "Sixty"))], "a string, b string")
    row = df.select(merkle.tree(F.col("a")).alias("a"), merkle.tree(F.col("b")).alias("b")).select(
        "a", "b", merkle.likeness(F.col("a"), F.col("b")).alias("near")).head()
    (root_a, a), (root_b, b) = (t.fingerprint.split(":") for t in (row.a, row.b))
    assert root_a != root_b and 0.7 < row.near < 1
    differing = [(i, j) for i, (s, t) in enumerate(zip(a.split(";"), b.split(";"))) for j, (p, q) in enumerate(zip(s.split(","), t.split(",")))
                 if p != q]
    assert differing == [(1, 0)]


def test_edited_text_is_nearer_than_the_next(spark):
    got = queries.op7_document_fingerprints(spark, "/root/testdata/sf0.01").where("n_chars > 300").toPandas()
    assert (got.near_edited > got.near_next).mean() > 0.99


def test_texts_are_shuffled_once(spark, sf_dir):
    plan = queries.op7_document_fingerprints(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan and "SinglePartition" not in plan
