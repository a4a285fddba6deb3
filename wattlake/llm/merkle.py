"""Document fingerprints: a Merkle tree over sections, paragraphs and pieces of every text.

A section is a run of lines with the blank lines that follow, a paragraph is a line, and a piece is a sentence or the next
``PIECE`` characters of a longer one. Pieces cover the text without gaps, so texts are equal exactly when their
trees are. A leaf is the hash of a piece, an inner node the hash of its children, and the root tests equality.

The fingerprint writes the root and, by section and paragraph, a short hash and the length of every piece. Where two
fingerprints differ, the first branches that do tell section, paragraph and piece of the edit. Likeness is the share
of characters in pieces that both have, of the longer text; it is 1 for equal roots only.

Neighbours by descending id are found without a global sort: a random sample of ids, one in ``bucket_rows`` and at
most ``MAX_BUCKETS`` in all, cuts the ids into buckets. A bucket's last row needs the first row of the next
bucket, and that row is the sampled id itself: it is sent to both. So texts are shuffled once.

Defined cases: a null text counts as empty; the empty text has a root and no pieces. Documents follow each other by descending
id, repeated ids by their texts, null ids last; after the last comes the first, so a single document follows itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import let, texts_of

PIECE = 80
MAX_BUCKETS = 1 << 16
SECTION = r"\n++|(?:[^\n]++\n?)++\n*+"
PARAGRAPH = r"[^\n]*+\n|[^\n]++"
SENTENCE = r"[^.!?]{1,%d}[.!?]*|[.!?]+" % PIECE
HASH_BITS, LENGTH_BITS = 32, 16


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _key(piece: Column, digest: Column) -> Column:
    """The first 32 bits of a piece's hash above 16 bits of its length."""
    head = F.conv(F.substring(digest, F.lit(1), F.lit(HASH_BITS // 4)), 16, 10).cast("bigint")
    return head * (1 << LENGTH_BITS) + F.least(F.length(piece), F.lit((1 << LENGTH_BITS) - 1))


def tree(text: Column) -> Column:
    """struct(root, fingerprint, keys) of a text."""
    leaf = lambda x: let(F.md5(x), lambda h: F.struct(h.alias("hash"), _key(x, h).alias("key")))
    paragraph = lambda p: let(F.transform(_all(p, SENTENCE), leaf), lambda found: F.struct(
        F.md5(F.array_join(found["hash"], "")).alias("hash"), found["key"].alias("keys")))
    section = lambda s: let(F.transform(_all(s, PARAGRAPH), paragraph), lambda found: F.struct(
        F.md5(F.array_join(found["hash"], "")).alias("hash"), found["keys"].alias("paragraphs")))
    shown = lambda keys: F.array_join(F.transform(keys, lambda k: F.lower(F.lpad(F.hex(k), 12, "0"))), "")

    def whole(sections: Column) -> Column:
        root = F.md5(F.array_join(sections["hash"], ""))
        listed = F.array_join(F.transform(sections["paragraphs"], lambda s: F.array_join(F.transform(s, shown), ",")), ";")
        return let(root, lambda r: F.struct(r.alias("root"), F.concat_ws(":", r, listed).alias("fingerprint"),
                                            F.flatten(F.flatten(sections["paragraphs"])).alias("keys")))
    return let(F.transform(_all(text, SECTION), section), whole)


def likeness(a: Column, b: Column) -> Column:
    """Of two trees: 1 if the roots are equal, else the shared part of the distinct pieces' characters, below 1."""
    weight = lambda keys: F.aggregate(keys, F.lit(0).cast("bigint"), lambda total, k: total + k % (1 << LENGTH_BITS))
    larger = F.greatest(weight(F.array_distinct(a["keys"])), weight(F.array_distinct(b["keys"])))
    return F.when(a["root"] == b["root"], F.lit(1.0)).otherwise(
        weight(F.array_intersect(a["keys"], b["keys"])) / (larger + 1))


# ---------------------------------------------------------------- neighbours

def _below(bounds: Column, n: int, value: Column) -> Column:
    """How many of ``n`` ascending bounds are less than ``value``, by binary search."""
    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        less = F.coalesce(F.get(bounds, middle) < value, F.lit(False))
        return F.struct(F.when(less, middle + 1).otherwise(state["low"]).alias("low"),
                        F.when(less, state["high"]).otherwise(middle).alias("high"))
    start = F.struct(F.lit(0).alias("low"), F.lit(n).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(n.bit_length())), start, halve, lambda s: s["low"])


def bucketed(docs: DataFrame, bucket_rows: int = 64) -> DataFrame:
    """``docs`` (doc_id, text) with ``bucket`` and ``extra``: sorted by (extra, doc_id descending, text), each row of a
    bucket that is not extra is followed by its next document."""
    size = docs.agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("top")).head()
    every = max(bucket_rows, -(-size.n // MAX_BUCKETS))
    sampled = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0, F.lit(False))
    chosen = sampled & F.col("doc_id").isNotNull()
    bounds = sorted(r.doc_id for r in docs.where(chosen).select("doc_id").distinct().collect())
    if bounds:
        listed = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
        own = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(_below(listed, len(bounds), F.col("doc_id")))
    else:
        own = F.lit(0)
    place = lambda bucket, extra: F.struct(bucket.cast("int").alias("bucket"), F.lit(extra).alias("extra"))
    places = F.array(place(own, 0),
                     F.when(chosen, place(own + 1, 1)),  # the first of its bucket follows the last of the one above
                     F.when(F.col("doc_id").eqNullSafe(F.lit(size.top).cast("bigint")), place(F.lit(0), 2)))
    return (docs.withColumn("place", F.explode(F.filter(places, lambda p: p.isNotNull())))
            .select("doc_id", "text", "place.bucket", "place.extra"))


# ---------------------------------------------------------------- operator

def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, tree): narrow, nothing is shuffled."""
    return (texts_of(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
            .withColumn("tree", tree(F.col("text"))))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = 64) -> DataFrame:
    """(doc_id, text, tree, next_text, next_tree): every document beside the one that follows it."""
    rows = (texts_of(docs, id_col, text_col)
            .select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")))
    within = Window.partitionBy("bucket").orderBy("extra", F.desc_nulls_last("doc_id"), "text")
    return (bucketed(rows, bucket_rows).repartition("bucket").withColumn("tree", tree(F.col("text")))
            .withColumn("next", F.lead(F.struct("text", "tree")).over(within)).where("extra = 0")
            .select("doc_id", "text", "tree", F.col("next.text").alias("next_text"), F.col("next.tree").alias("next_tree")))


def spliced(text: Column, following: Column) -> Column:
    """``text`` whose last third is replaced by as many first characters of ``following``, or all it has."""
    third = F.floor(F.length(text) / 3).cast("int")
    return let(third, lambda n: F.concat(F.left(text, F.length(text) - n), F.left(following, n)))
