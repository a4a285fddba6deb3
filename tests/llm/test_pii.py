import random
import re

import pytest
from helpers import ODD, docs
from pyspark.sql import functions as F

from wattlake.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def brute(text):
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(f[2] for f in sorted(found))


def base_spans(spark, texts):
    df = docs(spark, [(i, t, None) for i, t in enumerate(texts)])
    got = pii.find_spans(df).select("doc_id", pii.listed(pii.base_only(F.col("spans"))).alias("s")).collect()
    return [r.s for r in sorted(got)]


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(1)
    parts = ["a", "B", ".", "@", "-", "_", "+", "1", "4", "0", " ", "(", ")", "é", "😀", "%", "\n", "1.2.3.4", "x@y.z",
             "4111111111111111", "+49 30 1234567", "300.1.1.1"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 50))) for _ in range(400)]
    texts += [None, "", "a" * 200_000, "1" * 100_000 + ".", "a." * 50_000 + "@", "+" + "1 " * 50_000, "x@" + "a." * 50_000 + "b",
              "a@b.c_d@e.f", "x@y.z " * 600]
    assert base_spans(spark, texts) == [brute(t) for t in texts]


@pytest.mark.parametrize("text, spans", [
    ("DE89 3704 0044 0532 0130 00", "iban:0:27"), ("DE88 3704 0044 0532 0130 00", ""),
    ("ssn 123-45-6789", "national_id:4:15"), ("it is 123-45-6789", ""), ("serial no, ssn 123-45-6789", ""),
    ("call 030 123 4567", "local_phone:5:17"), ("030 123 4567", ""), ("4111111111111111 12", "lone_card:0:16"),
    ("password=b7db7aa4a5fcc78305", "secret:9:27"), ("b7db7aa4a5fcc78305", ""), ("hotel 030 123 4567", ""),
    ("4111 1111 1111 1111", "card:0:19")])
def test_checks_and_context(spark, text, spans):
    row = pii.find_spans(docs(spark, [(1, text, None)])).select(pii.listed(F.col("spans")).alias("s")).head()
    assert row.s == spans


def test_redaction(spark):
    text = "write a@b.co or +1 (988) 555-2485, pay 4111111111111111 from 10.0.0.1, token: 24be64439e3e49cf46b2"
    df = docs(spark, [(1, text, None), (2, None, None), (3, "clean", None)])
    got = [r.t for r in sorted(df.select("doc_id", pii.redact(F.col("text")).alias("t")).collect())]
    assert got == ["write [EMAIL] or [PHONE], pay [CARD] from [IP], token: [SECRET]", None, "clean"]


def test_redaction_replaces_the_spans_and_nothing_else(spark):
    rng = random.Random(8)
    parts = ["+49 30 1234567", "250 000 000", "a@b.co", "10.0.0.1", "4111 1111 1111 1111", "isbn 4111111111111111 12", "call 030 123 4567",
             "ssn 123-45-6789", "DE89 3704 0044 0532 0130 00", "password=b7db7aa4a5fcc78305", "über", "😀", "serves", "serial", "\n"]
    texts = ["+49 30 1234567 serves 250 000 000 users", "phone 4111111111111111 isbn 4111111111111111 12", "a@b.co" * 3]
    texts += [" ".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(200)]
    df = docs(spark, [(i, t, None) for i, t in enumerate(texts)])
    spans = {r.doc_id: r.spans for r in pii.find_spans(df).collect()}
    for r in df.select("doc_id", pii.redact(F.col("text")).alias("t")).collect():
        text, want, at = texts[r.doc_id], "", 0
        for s in spans[r.doc_id]:
            if s.start >= at:
                want += text[at:s.start] + f"[{s.kind.upper()}]"
            at = max(at, s.end)
        assert r.t == want + text[at:]
    first = df.where("doc_id = 0").select(pii.redact(F.col("text")).alias("t")).head().t
    assert first == "[PHONE] serves 250 000 000 users"


def test_running_totals(spark):
    for n in (0, 1, 255, 256, 257, 1000):
        df = spark.range(1).select(F.array(*[F.lit(i % 7) for i in range(n)]).cast("array<bigint>").alias("x"))
        got = df.select(pii.running_totals(F.col("x")).alias("t")).head().t
        assert got == [sum(j % 7 for j in range(i + 1)) for i in range(n)]


def test_odd_rows(spark):
    assert pii.find_spans(docs(spark, ODD)).count() == len(ODD)
    assert pii.find_spans(docs(spark, [])).count() == 0


def test_only_built_in_expressions(spark, sf_dir):
    plan = pii.find_spans(docs(spark, ODD))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ArrowEval" not in plan and "BatchEval" not in plan
