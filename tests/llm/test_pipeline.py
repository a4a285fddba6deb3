import re

import corpus_pipeline
from helpers import ODD, docs
from test_langid import made
from test_packing import brute_pieces, check_places
from test_simhash import brute_components, brute_fingerprint

from wattlake.llm import langid, pii


def test_stages_equal_brute_force(spark, tmp_path):
    """Each stage against a plain version of its rule, on its own input."""
    rows = made(80) + [(1000, "привет всем", "ru"), (1001, None, "aa"), (1002, "12 34", None)]
    rows += [(2000 + i, rows[i][1].upper(), rows[i][2]) for i in range(40)]  # copies
    rows[3] = (3, rows[3][1] + " mail a@b.co 10.0.0.1", rows[3][2])
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    start = spark.read.parquet(f"{tmp_path}/documents.parquet")
    (_, first), (_, second), (_, third), (_, fourth) = corpus_pipeline.STAGES

    one = first(spark, start, str(tmp_path)).cache()
    from pyspark.sql import functions as F
    model = langid.train(start.where(F.pmod(langid.crc_of_id(), F.lit(4)) != 2))
    assert sorted(r.doc_id for r in one.collect()) == sorted(i for i, t, _ in rows if not model.predict(t)[2])
    assert {1001, 1002}.isdisjoint({r.doc_id for r in one.collect()}) and one.columns == start.columns

    two = second(spark, one, str(tmp_path)).cache()
    groups = brute_components([(r.doc_id, brute_fingerprint(r.text)) for r in one.collect()])
    assert sorted(r.doc_id for r in two.collect()) == sorted(set(groups.values())) and two.columns == start.columns

    three = third(spark, two, str(tmp_path)).cache()
    assert three.columns == start.columns and [f.dataType for f in three.schema] == [f.dataType for f in start.schema]
    texts = {r.doc_id: r.text for r in three.collect()}
    before = {r.doc_id: r.text for r in two.collect()}
    for key, text in texts.items():
        assert text == re.sub(r"10\.0\.0\.1", "[IP]", before[key].replace("a@b.co", "[EMAIL]"))
    assert all(r.n_chars == len(r.text) for r in three.collect())

    four = fourth(spark, three, str(tmp_path)).toPandas()
    check_places(four, 2048)
    got = {i: list(g.sort_values("piece")[["piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None))
           for i, g in four.groupby("doc_id")}
    assert got == {k: brute_pieces(t) for k, t in texts.items()}


def test_run_equals_its_stages(spark, sf_dir):
    whole = corpus_pipeline.run(spark, sf_dir)
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, sf_dir)
    digest = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, whole.select(*digest).collect())) == sorted(map(tuple, frame.select(*digest).collect()))


def test_odd_rows_and_no_rows(spark, tmp_path):
    for name, rows in (("odd", ODD + made(40)), ("none", [])):
        docs(spark, rows).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        got = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert (got.count() > 0) == bool(rows)


def test_redaction_is_the_spans(spark):
    """What the stage removes is what the operator reports."""
    text = "x a@b.co y 4111111111111111 z +49 30 1234567, 10.0.0.1"
    df = docs(spark, [(1, text, "aa")])
    spans = pii.find_spans(df).head().spans
    masked = df.select(pii.redact(df.text)).head()[0]
    assert [s.kind.upper() for s in spans] == re.findall(r"\[([A-Z_]+)\]", masked)
    assert all(text[s.start:s.end] not in masked for s in spans)
