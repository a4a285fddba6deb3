"""SimHash near-duplicates by bit-sliced comparison.

A text's fingerprint has a bit set where over half of its shingle hashes have it. Two fingerprints link
when they differ in at most ``max_distance`` bits. Fingerprints that can link agree in all bits of some
three of six blocks (three differing bits touch three blocks at most), so each distinct fingerprint is
put into twenty buckets by 31 to 33 of its bits, and only rows of one bucket are compared.

Comparison is vertical: plane j holds bit j of 64 fingerprints in one word. A bucket's rows are laid out
side by side, the planes are shifted by a lag and XORed, and carry-save counters add up the differing
bits of 64 pairs at once; words whose pairs all exceed the radius are dropped before the last plane.

Buckets above ``block_rows`` are cut into blocks, and each pair of blocks is a task's group of its own,
so a bucket of any size is compared whole. Groups give spanning links only, never all pairs.

Defined cases: a null or empty text, or one without words, has fingerprint zero and links like any other. A row
with null id keeps a null id; a component's id is its smallest id that is not null. Repeated ids
and rows each keep a row of their own. Texts of any length are read in pieces of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import components, stored, texts_of
from wattlake.llm.words import give_back

SEED = 42
PIECE_BYTES = 1 << 20
SPACES = b" \t\n\v\f\r"


# ---------------------------------------------------------------- fingerprints

def shingle_hashes(text: bytes, words: int) -> Iterator[np.ndarray]:
    """Hashes of all shingles of a UTF-8 text, in arrays of bounded size."""
    held: list[bytes] = []
    any_shingle = False
    for piece in _pieces(text):
        tokens = held + piece.lower().split()
        if len(tokens) >= words:
            any_shingle = True
            joined = b" ".join(tokens)
            ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
            starts = np.concatenate([[0], ends[:-1] + 1])
            cuts = zip(starts[:len(tokens) - words + 1].tolist(), ends[words - 1:].tolist())
            digest = xxhash.xxh64_intdigest
            yield np.array([digest(joined[a:b], SEED) for a, b in cuts], np.uint64)
        held = tokens[max(0, len(tokens) - words + 1):] if words > 1 else []
    if not any_shingle and held:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], np.uint64)


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces that end at white space."""
    start = 0
    while start < len(text):
        end = start + PIECE_BYTES
        while end < len(text) and text[end] not in SPACES:
            end += 1
        yield text[start:end]
        start = end


def fingerprint(text: bytes | None, words: int = 3) -> int:
    counts, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text or b"", words):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0]) if total else 0


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``; narrow, nothing is shuffled."""
    rows = texts_of(docs, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            values = np.array([fingerprint(t.as_py(), words) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["doc_id", "fp"])
        give_back()

    return rows.mapInArrow(run, f"doc_id {id_type.simpleString()}, fp bigint")


# ---------------------------------------------------------------- comparison

def bit_planes(values: np.ndarray) -> np.ndarray:
    """(64, words): bit i of word w of plane j is bit j of value 64 * w + i. One empty word follows."""
    padded = np.zeros((len(values) // 64 + 2) * 64, np.uint64)
    padded[:len(values)] = values
    bits = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def near_lanes(planes: np.ndarray, lanes: np.ndarray, lag: int, radius: int, every: int = 8) -> np.ndarray:
    """Rows i among ``lanes`` (booleans) whose value is within ``radius`` bits of that of row i + lag."""
    packed = np.zeros(planes.shape[1] * 8, np.uint8)
    mask = np.packbits(lanes, bitorder="little")
    packed[:len(mask)] = mask
    alive = packed.view("<u8")
    words = np.flatnonzero(alive)
    alive = alive[words]
    skip, shift = divmod(lag, 64)
    last = planes.shape[1] - 1
    counters = [np.zeros(len(words), np.uint64) for _ in range(max(1, radius.bit_length()))]
    over = np.zeros(len(words), np.uint64)

    def differing(plane: np.ndarray) -> np.ndarray:
        other = plane[np.minimum(words + skip, last)]
        if shift:
            other = (other >> np.uint64(shift)) | (plane[np.minimum(words + skip + 1, last)] << np.uint64(64 - shift))
        return plane[words] ^ other

    for j in range(0, 64, 2):
        x, y = differing(planes[j]), differing(planes[j + 1])
        either = x ^ y
        carry = (x & y) | (counters[0] & either)
        counters[0] ^= either
        for k in range(1, len(counters)):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if (j + 2) % every == 0:
            alive = alive & ~_exceeds(counters, over, radius)
            kept = np.flatnonzero(alive)
            if not len(kept):
                return kept
            if len(kept) < len(words):
                words, alive, over = words[kept], alive[kept], over[kept]
                counters = [c[kept] for c in counters]
    at, bit = np.nonzero(np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return words[at] * 64 + bit


def _exceeds(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose count is above the radius: compared from the highest counter bit down."""
    above, equal = over.copy(), ~over
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            above |= equal & counters[k]
            equal &= ~counters[k]
    return above


def spanning_links(values: np.ndarray, groups: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all rows of a group that links within ``radius`` connect. ``groups`` is sorted."""
    n = len(values)
    ends = np.searchsorted(groups, groups, side="right")
    ahead = ends - np.arange(n) - 1
    planes, root = bit_planes(values), np.arange(n)
    for lag in range(1, int(ahead.max(initial=0)) + 1):
        lanes = ahead >= lag
        lanes[:n - lag] &= root[:n - lag] != root[lag:]
        left = near_lanes(planes, lanes, lag, radius)
        while len(left):
            a, b = root[left], root[left + lag]
            left, a, b = left[a != b], a[a != b], b[a != b]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root != root[root]).any():
                root = root[root]
    moved = np.flatnonzero(root != np.arange(n))
    return values[moved], values[root[moved]]


def masks(blocks: int = 6, agreeing: int = 3) -> list[int]:
    """The bits of each choice of ``agreeing`` out of ``blocks`` blocks of a fingerprint."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    block = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(block, agreeing)]


def links(fps: DataFrame, max_distance: int = 3, block_rows: int = 1024, chunk_rows: int = 1 << 15) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp`` that connect all that are within ``max_distance``."""
    signed = [m - (1 << 64) if m >> 63 else m for m in masks(max_distance + 3, 3)]
    keys = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("bigint")).alias("key"))
                     for t, m in enumerate(signed)])
    rows = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.t", "k.key")
    buckets = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block_rows).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    other = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
        F.array_remove(F.sequence(F.lit(0), F.col("blocks") - 1), F.col("own")))
    shared = (rows.join(buckets, ["t", "key"]).withColumn("blocks", blocks).withColumn("own", own)
              .withColumn("other", F.explode(other))
              .select("fp", F.xxhash64("t", "key", F.least("own", "other"), F.greatest("own", "other")).alias("grp")))

    def run(batches):
        held = None
        for batch in batches:
            part = np.array([batch.column(0).to_numpy(zero_copy_only=False),
                             batch.column(1).to_numpy(zero_copy_only=False)], np.int64)
            held = part if held is None else np.concatenate([held, part], axis=1)
            if held.shape[1] >= chunk_rows:
                cut = int(np.searchsorted(held[1], held[1, -1]))  # the last group may go on
                yield _linked(held[:, :cut], max_distance)
                held = held[:, cut:]
        if held is not None:
            yield _linked(held, max_distance)

    return (shared.repartition("grp").sortWithinPartitions("grp")
            .mapInArrow(run, "a bigint, b bigint").distinct())


def _linked(rows: np.ndarray, radius: int) -> pa.RecordBatch:
    a, b = spanning_links(rows[0].view(np.uint64), rows[1], radius)
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])


# ---------------------------------------------------------------- operator

def near_duplicates(docs: DataFrame, words: int = 3, max_distance: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id), one row per row of ``docs``. Needs ``max_distance`` of 3 or less."""
    if not 0 <= max_distance <= 3:
        raise ValueError("max_distance must be 0 to 3")
    prints = stored(fingerprints(docs, words, id_col, text_col), "fingerprints")
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(first.select("fp"), max_distance)).select(F.col("node").alias("fp"), "root")
    rooted = first.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = rooted.join(ids, "root").select("fp", "component_id")
    return prints.join(by_fp, "fp", "left").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, words: int = 3, max_distance: int = 3, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each component left, with all their columns.

    The smallest id of a component stays. Rows that repeat this id are settled by the smallest hash of the
    whole row, and a component without any id keeps the row with the smallest hash. Hashes of rows are
    compared, never texts, so only the join that drops rows moves texts, once.
    """
    marked = docs.select(F.struct("*").alias("row"), F.col(f"`{text_col}`").alias("text"),
                         F.struct(F.col(f"`{id_col}`").isNull().alias("no_id"), F.col(f"`{id_col}`").alias("id"),
                                  F.xxhash64(F.struct("*")).alias("row_hash")).alias("key"))
    found = near_duplicates(marked, words, max_distance, "key")
    first = stored(found.where(F.col("doc_id") == F.col("component_id"))
                   .groupBy("doc_id").agg(F.count(F.lit(1)).alias("copies")).select("doc_id.id", "doc_id.row_hash", "copies"),
                   "first_of_components")
    rows = marked.select("row", "key.id", "key.row_hash")
    kept = lambda some: rows.join(some, rows.id.eqNullSafe(some.id) & (rows.row_hash == some.row_hash)).select(
        rows.row, rows.id, rows.row_hash)
    once, again = first.where("copies = 1"), first.where("copies > 1")
    result = kept(once).select("row.*")
    if not again.isEmpty():  # rows that are the same in every column
        result = result.union(kept(again).groupBy("id", "row_hash").agg(F.first("row").alias("row")).select("row.*"))
    return result


def hex_of(fp):
    """Sixteen lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
