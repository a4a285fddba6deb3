"""Documents to overlapping chunks with metadata and repeatable ids. All map-only."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SIZE, OVERLAP = 1000, 200            # characters
TOKENS, TOKEN_OVERLAP = 600, 75      # words; 12.5 % overlap
SEPARATORS = ("\n\n", "\n", " ", "")
_STRIDES_PER_BLOCK = 64


def _starts(length: Column, size: int, overlap: int, base: Column | int = 1) -> Column:
    """First positions of windows of ``size`` that cover ``length`` with the given overlap."""
    stride = size - overlap
    windows = F.greatest(F.ceil((length - overlap) / F.lit(stride)), F.lit(1)).cast("int")
    return F.transform(F.sequence(F.lit(0), windows - 1), lambda i: i * stride + base)


def chunk_fixed(docs: DataFrame, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """Windows of ``size`` characters, each starting ``size - overlap`` after the one before.

    Columns: those of ``docs`` without ``text``, then ``pos`` and ``text``. Long texts are first cut
    into blocks of many windows, because taking a substring walks the text from its start.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")
    stride = size - overlap
    block = _STRIDES_PER_BLOCK * stride
    others = [c for c in docs.columns if c != "text"]
    length = F.length("text")
    block_count = F.greatest(F.ceil((length - overlap) / F.lit(block)), F.lit(1)).cast("int")
    blocks = docs.select(
        *others,
        F.posexplode(F.transform(
            F.sequence(F.lit(0), block_count - 1),
            lambda i: F.substring(F.col("text"), i * block + 1, F.lit(block + overlap)),
        )).alias("block", "part"),
    )
    windows = blocks.select(
        *others, "block",
        F.posexplode(F.transform(
            _starts(F.length("part"), size, overlap),
            lambda start: F.substring(F.col("part"), start, F.lit(size)),
        )).alias("window", "text"),
    )
    return windows.select(
        *others, (F.col("block") * _STRIDES_PER_BLOCK + F.col("window")).cast("int").alias("pos"), "text"
    )


def chunk_tokens(docs: DataFrame, size: int = TOKENS, overlap: int = TOKEN_OVERLAP) -> DataFrame:
    """Windows of ``size`` words; columns as for ``chunk_fixed``."""
    others = [c for c in docs.columns if c != "text"]
    words = docs.select(*others, F.filter(F.split("text", r"\s+"), lambda w: w != "").alias("words"))
    windows = F.transform(
        _starts(F.size("words"), size, overlap),
        lambda start: F.array_join(F.slice("words", start, F.lit(size)), " "),
    )
    # an empty list instead of a filter, which would split the text a second time
    return words.select(
        *others, F.posexplode(F.when(F.size("words") > 0, windows).otherwise(F.array())).alias("pos", "text")
    )


# ---------------------------------------------------------------- separator-aware

def _pack(pieces: list[str], size: int, overlap: int) -> Iterator[str]:
    """Join neighbouring pieces up to ``size``; each chunk repeats whole pieces worth up to ``overlap``."""
    window: deque[str] = deque()
    length = 0
    for piece in pieces:
        if window and length + len(piece) > size:
            yield "".join(window)
            while length > overlap or (length and length + len(piece) > size):
                length -= len(window.popleft())
        window.append(piece)
        length += len(piece)
    if window:
        yield "".join(window)


def _split(text: str, size: int, overlap: int, separators: Sequence[str]) -> Iterator[str]:
    """Cut at the coarsest separator present, which stays at the head of the piece that follows.

    Pieces still too long are cut on their own by the finer separators and not joined with others.
    """
    level = next((i for i, s in enumerate(separators) if s in text), len(separators) - 1)
    separator, finer = separators[level], separators[level + 1:]
    if separator:
        head, *tail = text.split(separator)
        pieces = [p for p in (head, *(separator + t for t in tail)) if p]
    else:
        pieces = list(text)
    short: list[str] = []
    for piece in pieces:
        if len(piece) < size:
            short.append(piece)
            continue
        yield from _pack(short, size, overlap)
        short = []
        if finer:
            yield from _split(piece, size, overlap, finer)
        else:
            yield piece
    yield from _pack(short, size, overlap)


def split_recursive(text: str, size: int = SIZE, overlap: int = OVERLAP,
                    separators: Sequence[str] = SEPARATORS) -> list[str]:
    """Chunks of at most ``size`` characters, cut at the coarsest boundary that allows it, and trimmed."""
    chunks = [text] if len(text) < size else _split(text, size, overlap, separators)
    return [c for c in (chunk.strip() for chunk in chunks) if c]


def chunk_recursive(docs: DataFrame, size: int = SIZE, overlap: int = OVERLAP,
                    separators: Sequence[str] = SEPARATORS) -> DataFrame:
    """Chunks cut at paragraph, line, word and only then character boundaries; columns as above."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")
    separators = tuple(separators)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def split(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: split_recursive(t, size, overlap, separators) if t else [])

    others = [c for c in docs.columns if c != "text"]
    # Marked so that the optimizer does not evaluate it a second time to look for empty results.
    return docs.select(*others, split.asNondeterministic()("text").alias("parts")).select(
        *others, F.posexplode("parts").alias("pos", "text")
    )


# ---------------------------------------------------------------- sections and metadata

def split_sections(docs: DataFrame) -> DataFrame:
    """Pages and titled sections before chunking: adds ``page_number``, ``section``, ``section_title``.

    Pages end at form feeds; a section starts at a line ``# title``.
    """
    others = [c for c in docs.columns if c != "text"]
    pages = docs.select(*others, F.posexplode(F.split("text", "\f", -1)).alias("page", "page_text"))
    sections = pages.select(
        *others, (F.col("page") + 1).alias("page_number"),
        F.posexplode(F.split("page_text", r"(?m)(?=^#{1,6} )", -1)).alias("section", "text"),
    )
    title = F.regexp_extract("text", r"^#{1,6} +([^\n]*)", 1)
    return sections.withColumn("section_title", F.when(title != "", title)).where("text <> ''")


def with_metadata(chunks: DataFrame, version: Column, tags: Sequence[str] = (),
                  position: Sequence[str] = ("pos",)) -> DataFrame:
    """Adds ``chunk_id`` (the same for the same document, position and text), ``version`` and ``tags``.

    ``tags`` lists those of the given words that the chunk contains.
    """
    wanted = F.array(*[F.lit(t) for t in tags]) if tags else F.array().cast("array<string>")
    return chunks.withColumns({
        "chunk_id": F.sha2(F.concat_ws("|", F.col("doc_id"), *[F.col(p) for p in position], F.col("text")), 256),
        "version": version,
        "tags": F.filter(wanted, lambda t: F.contains(F.lower("text"), t)),
    })
