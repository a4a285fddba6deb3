"""Fixtures shared by the tests of the training-data operators."""

from pyspark.sql import DataFrame

LONG = "lorem ipsum dolor " * 20_000
EXTRA = "doc_id long, text string, lang string, source string, n_chars long, start string, fp string, key int, row string"


def docs(spark, rows) -> DataFrame:
    """Documents with extra columns whose names the operators use inside."""
    full = [(i, t, lang, "s", len(t or ""), "x", "y", 1, "z") for i, t, lang in rows]
    return spark.createDataFrame(full, EXTRA)


ODD = [(1, None, None), (2, "", "en"), (3, "12 !?", None), (None, "no id here", "en"), (4, "same text", "en"), (4, "same text", "en"),
       (5, "same text", None), (6, LONG, "la"), (7, "\n\n", "en"), (None, None, None)]


def by_id(df, *columns) -> dict:
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect()}
