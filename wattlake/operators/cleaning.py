"""Text cleaning: white space and boilerplate lines."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.session import scratch_path

# Beyond these sizes lines are matched by a join instead of by a hash set in the plan. Both give the same rows.
MAX_INLINE_LINES = 5_000
MAX_INLINE_BYTES = 4 * 1024 * 1024


def normalise_line(line: Column) -> Column:
    """Runs of blanks become one, ends are trimmed."""
    return F.trim(F.regexp_replace(line, r"[ \t\r\f]+", " "))


def text_lines(text: Column) -> Column:
    return F.transform(F.split(text, "\n", -1), normalise_line)


def boilerplate_lines(docs: DataFrame, min_docs: int, min_share: float = 0.0) -> DataFrame:
    """Lines found in at least ``min_docs`` documents and in ``min_share`` of them.

    Counting runs twice over the texts but shuffles no text: first over 64-bit line hashes, then
    over the texts of the few lines whose hash was frequent, which also rules out collisions. Each
    document counts a line once, before anything is shuffled. A line in a third of all documents
    is a partial count per task.

    Columns: ``line, n_docs``.
    """
    if min_share > 0:
        min_docs = max(min_docs, math.ceil(docs.count() * min_share))
    lines = docs.select(F.explode(F.array_distinct(text_lines(F.col("text")))).alias("line")).where("line <> ''")
    hashed = lines.select("line", F.xxhash64("line").alias("h"))
    frequent = hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs).select("h")
    # Stored, so that the join knows how few they are before any line is shuffled.
    candidates = hashed.join(_stored(frequent, "frequent"), "h", "left_semi")
    return candidates.groupBy("line").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") >= min_docs)


def _is_title(line: Column) -> Column:
    return line.rlike(r"^#{1,6} ")


def _reassemble(lines: Column) -> Column:
    """Lines to text, with no blank lines at the ends and never two in a row."""
    joined = F.array_join(lines, "\n")
    return F.regexp_replace(F.regexp_replace(joined, r"\n{3,}", "\n\n"), r"^\n+|\n+$", "")


def clean_text(docs: DataFrame, boilerplate: DataFrame | None = None,
               max_inline_lines: int = MAX_INLINE_LINES) -> DataFrame:
    """``docs`` with ``text`` cleaned: white space normalised, boilerplate lines taken out, titles kept.

    Rows are cleaned one by one, whatever their ids, and a null text stays null. The boilerplate lines are looked
    up in a hash set inside each document, so the texts are not shuffled. A line must occur in ``min_docs``
    documents, hence their number is at most the average number of lines per document times documents /
    ``min_docs``; if they are many all the same, lines are matched by a join, with the same result.
    """
    if boilerplate is None:
        return docs.withColumn("text", _reassemble(text_lines(F.col("text"))))
    lines_out = _stored(boilerplate.select("line").where("line IS NOT NULL").distinct(), "boilerplate")
    size = lines_out.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("line")), F.lit(0)).alias("bytes")
    ).first()
    if size.n > max_inline_lines or size.bytes > MAX_INLINE_BYTES:
        return _clean_by_join(docs, lines_out)
    unwanted = [r.line for r in lines_out.collect()]
    kept = F.filter(text_lines(F.col("text")), lambda line: _is_title(line) | ~line.isin(unwanted))
    return docs.withColumn("text", _reassemble(kept))


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` in the shared folder, so that it is computed once and its size is known to the planner."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _clean_by_join(docs: DataFrame, lines_out: DataFrame) -> DataFrame:
    """The same result without a size limit: lines of the distinct texts as rows, joined on their text.

    Equal texts are cleaned alike, so a text is known by its hash and not by its id, which may repeat. Lines
    are salted against the boilerplate list, because one of them may be a third of all lines.
    """
    spark = docs.sparkSession
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.withColumn("__key", F.sha2("text", 256))
    # One row per text is chosen before the shuffle of its lines; a copied text costs one row per task.
    texts = keyed.where("text IS NOT NULL").groupBy("__key").agg(F.first("text").alias("text"))
    exploded = texts.select("__key", F.posexplode(text_lines(F.col("text"))).alias("pos", "line"))
    exploded = exploded.withColumn("salt", F.pmod(F.xxhash64("__key", "pos"), F.lit(salts)).cast("int"))
    salted = lines_out.select("line", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    kept = exploded.where(_is_title(F.col("line"))).unionByName(
        exploded.where(~_is_title(F.col("line"))).join(salted, ["line", "salt"], "left_anti").select(*exploded.columns)
    )
    rebuilt = kept.groupBy("__key").agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("parts"))
    cleaned = rebuilt.select("__key", _reassemble(F.transform("parts", lambda p: p["line"])).alias("__text"))
    text = F.when(F.col("text").isNotNull(), F.coalesce("__text", F.lit("")))  # no line may be left
    return keyed.join(cleaned, "__key", "left").withColumn("text", text).select(*docs.columns)
