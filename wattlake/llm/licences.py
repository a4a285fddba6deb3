"""Licence scans by canonical digests.

A text is brought to a canonical form: lower case, no comment marks, no copyright lines, one spelling for words that licences
spell differently, and single blanks for punctuation and white space. The digest of a whole canonical text is looked up among the
digests of known licence texts, and the digest of every line among those of known notices. Known texts pass through the same
expressions, so they match however they are wrapped, cased or punctuated.

The known digests are a fixed list, so their table is broadcast; documents are not shuffled.

Defined cases: a null text, an empty one and one of punctuation only have the digest of the empty string and no licence. Every
row gives one row, repeats and null ids included. Texts of any length are read whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm.common import let, texts_of
from wattlake.llm.licence_texts import NOTICES, TEXTS

COMMENT_MARKS = r"(?dm)^[ \t]*(?:/\*+|\*+/|\*+|//+|#+|;+|--+)"
COPYRIGHT_LINES = r"(?dm)^[ \t]*(?:copyright[ \t]*(?:\(c\)|©|:|<|\[|[0-9]{4})|\(c\)[ \t]|©|all rights reserved)[^\n]*$"
# Spellings that mean the same in licences; the first becomes the second.
SPELLINGS = [
    ("licence", "license"), ("sub-license", "sublicense"), ("sub license", "sublicense"), ("non-commercial", "noncommercial"),
    ("non commercial", "noncommercial"), ("non-infringement", "noninfringement"), ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"), ("favour", "favor"), ("merchantibility", "merchantability"), ("per cent", "percent"),
    ("copyright owner", "copyright holder"), ("https:", "http:"), ("&", " and "),
]
PUNCTUATION = r"[^\p{L}\p{N}\n]+"


def canonical_lines(text: Column) -> Column:
    """The canonical form of each line that has one."""
    value = F.lower(F.coalesce(text, F.lit("")))
    value = F.regexp_replace(value, COMMENT_MARKS, " ")
    value = F.regexp_replace(value, COPYRIGHT_LINES, " ")
    value = reduce(lambda v, pair: F.replace(v, F.lit(pair[0]), F.lit(pair[1])), SPELLINGS, value)
    value = F.regexp_replace(value, PUNCTUATION, " ")
    return F.filter(F.transform(F.split(value, "\n"), lambda line: F.trim(line)), lambda line: line != "")


def whole_digest(lines: Column) -> Column:
    return F.md5(F.array_join(lines, " "))


def known(spark: SparkSession, entries: list[tuple[str, str]]) -> DataFrame:
    """(digest, licence) of known texts, each digest once."""
    rows = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(n).alias("licence"), F.lit(t).alias("text")) for n, t in entries])))
    return rows.groupBy(whole_digest(canonical_lines(F.col("text"))).alias("digest")).agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, texts: list[tuple[str, str]] = TEXTS, notices: list[tuple[str, str]] = NOTICES,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, licence, notices): the licence whose text the whole document is, and the licences its lines name."""
    spark = docs.sparkSession
    by_digest = {r.digest: r.licence for r in known(spark, notices).collect()}  # a fixed list
    digests = F.array(*[F.lit(d) for d in by_digest])
    licences = F.create_map(*[F.lit(x) for pair in by_digest.items() for x in pair])
    rows = texts_of(docs, id_col, text_col).select("doc_id", let(canonical_lines(F.col("text")), lambda lines: F.struct(
        whole_digest(lines).alias("digest"),
        F.array_intersect(F.transform(lines, lambda line: F.md5(line)), digests).alias("found"))).alias("t"))
    named = F.array_sort(F.array_distinct(F.transform(F.col("t.found"), lambda d: licences[d])))
    return (rows.select("doc_id", F.col("t.digest").alias("digest"), named.alias("notices"))
            .join(F.broadcast(known(spark, texts)), "digest", "left").select("doc_id", "digest", "licence", "notices"))
